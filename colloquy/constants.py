"""Fixed values of the dialogue format and of the text rules.

Everything here must equal what existing corpora and models expect, so it is
stated once, as plain text.
"""

# Dialogue tags and end of text.
USER = "<|user|>"
ASSISTANT = "<|assistant|>"
EOS = "<|endoftext|>"

# Special tokens in the order in which they follow the learned vocabulary.
SPECIALS = (EOS, USER, ASSISTANT)

BLOCK_SIZE = 512
CONTEXT_SIZE = 1024
SEED = 42
LABEL_IGNORE = -100
STOP_STRINGS = (EOS, "\n" + USER)
SESSION_END_WORDS = ("exit", "quit", "sair")
TRUE_WORDS = ("1", "true", "yes", "y", "on")

# Unicode white space. Neither Java's nor RE2's \s covers it; this class reads
# the same in both.
WS_CLASS = r"\t-\r\x1C-\x20\x{85}\p{Z}"
WS = f"[{WS_CLASS}]+"
# The same set spelled out, for trim().
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Control characters that become spaces; tab, line feed and carriage return stay.
CONTROL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F]"

CURLY_QUOTES = "\u2019\u201c\u201d"
STRAIGHT_QUOTES = "'\"\""
