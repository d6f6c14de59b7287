"""Small tables with the awkward rows every operator has to take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     # names that operators use for columns of their own
                     *[T.StructField(c, T.StringType()) for c in ("kept", "score", "node", "size", "hash", "bucket", "n", "label",
                                                                        "x.y", "doc_id.text")]])  # the last two need quoting

SENTENCE = "The quick brown fox number %d jumps over the lazy dog near river %d while seven birds sing in tree %d . "


def text(seed: int, sentences: int = 8) -> str:
    return "".join(SENTENCE % (seed * 7 + k, seed + k * 3, seed * k) for k in range(sentences)).strip()


def awkward_rows():
    rows = [(i, text(i), "en", f"s{i % 3}") for i in range(1, 25)]
    rows += [(30, None, None, None), (31, "", "", ""), (32, " \t\n ", "en", "s1"), (33, "one", "xx", "s0"),
             (34, "x" * 50_000, "en", "s2"), (35, " ".join(f"w{k}" for k in range(20_000)), "en", "s0"),
             (36, text(3), "en", "s1"),                       # exact copy of 3
             (5, text(5), "en", "s2"), (5, text(5), "en", "s2"),  # repeated rows
             (37, text(7, 12) + " extra words here", "de", "s0"),
             (38, "日本語 текст   😀 ▁ \u0000 end", "zz", "s1"),
             (None, "no id here at all", "fr", None), (39, "# * $ % & | < >\n# * $ % & | < >\na a a a a a", "en", "s0")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], DOCS)


def words(value: str | None) -> list[bytes]:
    return (value or "").encode().split()  # bytes split at ASCII white space only


def lower(value: str | None) -> list[bytes]:
    return [w.lower() for w in words(value)]
