"""Prompts for running conversations, with their history as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from colloquy.constants import ASSISTANT, CONTEXT_SIZE, SESSION_END_WORDS, USER
from colloquy.operators.prompts import truncate_to_context

OUTPUT = "conv_id long, turn long, prompt string, late boolean"
_STATE = "lines array<string>, last_turn long"


def stream_prompts(
    turns: DataFrame, max_len: int = CONTEXT_SIZE, idle_ms: int | None = None
) -> DataFrame:
    """A prompt for each user turn of a stream ``(conv_id, turn, role, text)``.

    Blank user input is skipped. ``exit``, ``quit`` or ``sair`` ends the session
    and clears its history. Rows of a micro-batch are taken in turn order; a row
    older than the history is taken as it arrives and flagged ``late``. A
    conversation idle for ``idle_ms`` is forgotten; that takes a query that keeps
    running, since timeouts schedule further batches without end.

    Prompts are cut to their last ``max_len`` tokens, as ``context_prompts`` does in
    batch. A line has at least one token, so the ``max_len`` lines that the state keeps
    hold all that can be in a prompt. Leaving drops the state.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        lines, last = state.get if state.exists else ([], -1)
        lines = list(lines)
        out = []
        rows = pd.concat(list(batches)).sort_values("turn", kind="stable")
        for turn, role, text in zip(rows["turn"], rows["role"], rows["text"]):
            turn, text, late = int(turn), text or "", int(turn) <= last
            last = max(last, turn)
            if role == "user":
                text = text.strip()
                if text.lower() in SESSION_END_WORDS:
                    lines, last = [], -1
                    continue
                if not text:
                    continue
                lines.append(f"{USER} {text}")
                out.append((int(key[0]), turn, "\n".join([*lines, ASSISTANT + " "]), late))
            else:
                lines.append(f"{ASSISTANT} {text}")
            lines = lines[-max_len:]
        if lines or last >= 0:
            state.update((lines, last))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["conv_id", "turn", "prompt", "late"])

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    prompts = turns.groupBy("conv_id").applyInPandasWithState(advance, OUTPUT, _STATE, "append", timeout)
    return truncate_to_context(prompts, "prompt", max_len).drop("tokens")
