from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, VariantType

from colloquy.constants import WS_CHARS
from colloquy.functions import text as T
from colloquy.functions import values as V
from tests.conftest import SF_DIR


class Visible(HTMLParser):
    """Text nodes outside script, style and template."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def visible(html):
    parser = Visible()
    parser.feed(html)
    parser.close()
    return " ".join(" ".join(parser.parts).split())


def shown(c):
    return T.collapse_ws(T.strip_html(c))


def test_strip_html_cases(apply):
    cases = {
        "a < b": "a < b",
        "a<b>c</b>": "a c",
        "x<!-- y -->z": "x z",
        "&amp;lt;": "&lt;",
        "&#233;": "é",
        "&#x1F600;": "😀",
        "&#150;": "–",
        "&copy 2020": "© 2020",
        "R&D &foo; &": "R&D &foo; &",
        "&#0;": "�",
        "<script>1<2</script>ok": "ok",
        "a<script>never closed <b>x": "a",
        "<!-- <script> -->kept</script>": "kept",
        '<a title="1>0">t</a>': "t",
        "<a title=\"<script>\">t</a><p>it's": "t it's",
        "<!DOCTYPE html><?php x ?>d": "d",
        "<TEMPLATE>no</TEMPLATE>yes": "yes",
        "<br/>line<br>": "line",
        "": "",
    }
    assert dict(zip(cases, apply(shown, list(cases)))) == cases


def test_strip_html_of_hostile_text(apply):
    quotes = '<a ' + '"q" ' * 50_000
    opened = "x<y " * 20_000
    assert apply(shown, [quotes, quotes + ">end", opened]) == [quotes.strip(), "end", opened.strip()]


def test_strip_html_equals_a_parser_on_all_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    for row in pages.select("html", shown(F.col("html")).alias("text")).collect():
        assert row["text"] == visible(row["html"])


def test_white_space(apply):
    assert apply(T.strip_ws, [f"{WS_CHARS}a b{WS_CHARS}", None]) == ["a b", None]
    assert apply(T.norm_space, [f"a{WS_CHARS}b c  ", None, ""]) == ["a b c", "", ""]


def test_clean_text(apply):
    raw = [
        "a  b",
        "x\x1cy\x0bz\x00",
        "‘q’ “d”",
        "<p>\x01 hi</p>\t<b>there</b>",
        "<script>a</script> \n",
        None,
    ]
    assert apply(T.clean_text, raw) == ["a b", "x y z", "‘q' \"d\"", "hi there", "", ""]


def test_norm_text_and_control(apply):
    assert apply(T.norm_text, ["<i>a</i>  b’s", None]) == ["a b's", ""]
    assert apply(T.strip_control, ["a\x00\x08\x0b\x0c\x1fb\t\n\r"]) == ["a     b\t\n\r"]
    assert apply(T.strip_tags, ["a<b>c", None]) == ["a c", ""]


def test_ensure_text_of_arrays(apply):
    out = apply(lambda c: T.ensure_text(c, ArrayType(StringType())), [["a", None, "b"], [], None], "array<string>")
    assert out == ["a None b", "", ""]


def test_unwrap_typed(spark):
    df = spark.createDataFrame(
        [([["a"], ["b"]], ("x",), []), (None, None, None), ([[]], (None,), ["s"])],
        "nested array<array<string>>, texts struct<texts:string>, flat array<string>",
    )
    cols = [V.unwrap_text(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]
    assert [tuple(r) for r in df.select(*cols).collect()] == [("a", "x", "[]"), ("", "", ""), ("[]", "", "s")]


def test_unwrap_variant(apply):
    cases = {
        "null": "", '[["a"],"b"]': "a", '{"texts":["x"]}': "x", "[]": "[]", "{}": "{}", "[null]": "",
        '{"text":null}': "", '"s"': "s", "3": "3", '{"text":{"texts":[["deep"]]}}': "deep",
        "[" * 30 + '"far"' + "]" * 30: "far",
    }
    out = apply(lambda c: V.unwrap_text(F.parse_json(c), VariantType()), list(cases))
    assert dict(zip(cases, out)) == cases


def test_unwrap_map(apply):
    out = apply(
        lambda c: V.unwrap_text(c, V.MapType(StringType(), StringType())),
        [{"text": "t", "texts": "u"}, {"texts": "u"}, {}, {"a": "b"}], "map<string,string>",
    )
    assert out == ["t", "u", "{}", '{"a":"b"}']


def test_first_or_self(apply):
    assert apply(lambda c: V.first_or_self(c, ArrayType(LongType())), [[3, 4], []], "array<bigint>") == [3, None]
    assert apply(lambda c: V.first_or_self(c, StringType()), ["x"]) == ["x"]


def test_coercion(apply):
    assert apply(lambda c: V.coerce_int(c, "f", StringType()), [" 12 ", "-3", "1_000"]) == [12, -3, 1000]
    assert apply(lambda c: V.coerce_int(c, "f", DoubleType()), [3.7, -3.7], "double") == [3, -3]
    assert apply(lambda c: V.coerce_float(c, "f", StringType()), ["1e3", " 2.5"]) == [1000.0, 2.5]
    assert apply(lambda c: V.coerce_bool(c, "f", StringType()), [" TRUE", "1", "on", "no", ""]) == [True, True, True, False, False]
    assert apply(lambda c: V.coerce_bool(c, "f", BooleanType()), [True, False], "boolean") == [True, False]


@pytest.mark.parametrize(
    "coerce, value", [(V.coerce_int, "3.7"), (V.coerce_int, None), (V.coerce_float, "x"), (V.coerce_bool, None)]
)
def test_coercion_names_the_field(apply, coerce, value):
    with pytest.raises(Exception, match="batch_size"):
        apply(lambda c: coerce(c, "batch_size", StringType()), [value])


def test_coercion_rejects_column_types():
    with pytest.raises(TypeError, match="fp16"):
        V.coerce_bool(F.col("v"), "fp16", IntegerType())


@pytest.mark.parametrize(
    "value", ["1", " 2.5 ", "1_000", "1_0.5_0e1_0", "-.5", "5.", "+inf", "Infinity", "-nan", "1e-3", "1d", "2.5F", "0x1p3", "1__0", "_1", "1_", "", ".", "e5", "1e"]
)
def test_float_text_reads_as_in_python(spark, value):
    df = spark.createDataFrame([(value,)], "v string").select(V.coerce_float(F.col("v"), "v", StringType()).alias("x"))
    try:
        want = float(value)
    except ValueError:
        with pytest.raises(Exception, match="not a value of type float"):
            df.collect()
    else:
        got = df.first()["x"]
        assert got == want or (got != got and want != want)


def test_text_of_booleans_and_floats(spark):
    row = spark.range(1).select(
        T.ensure_text(F.lit(True), BooleanType()).alias("b"), T.ensure_text(F.lit(1.5), DoubleType()).alias("d"),
        T.ensure_text(F.array(F.lit(False), F.lit(None)), ArrayType(BooleanType())).alias("a"),
        T.ensure_text(F.lit(None).cast("boolean"), BooleanType()).alias("n"),
    ).first()
    assert tuple(row) == ("True", "1.5", "False None", "")
    with pytest.raises(Exception, match="format this number"):
        spark.range(1).select(T.ensure_text(F.lit(1e16), DoubleType())).collect()


@pytest.mark.parametrize(
    "html, want", [("a<![CDATA[b]]>c", "a c"), ("a<![CDATA[b", "a "), ("a<!-- b", "a "), ("a < b", "a < b"), ("a<!-- b --> c", "a  c")]
)
def test_cdata_and_open_comments(apply, html, want):
    assert apply(T.strip_html, [html]) == [want]
