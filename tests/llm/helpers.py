"""Small tables and brute-force versions that the tests of this folder share."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use inside; a table may have such columns of its own.
CLASHES = ["digest", "n_points", "kept", "fp", "row_id", "score", "start", "key", "n", "words", "label", "u", "v"]


def edge_rows() -> list[tuple]:
    """Nulls, empty and long texts, repeated rows, equal ids with different texts, copies, odd characters."""
    long = " ".join(f"w{i % 977}x" for i in range(60_000))
    texts = ["", None, "a", "a b", "A B", "a  b\n", "a b c d e f g h", "a b c d e f g i", long, long + " tail",
             "Grüße, Ünïcödé – 日本語 𝒳 😀", "\x1c odd \x85 space here x", " \t\r\n\x0b\x0c", "<|endoftext|> 's don't",
             "one two three four five six seven eight nine ten", "é é"]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (7, "other text of an id seen before", None, None, None), (None, "a b", None, None, 3),
             (None, None, None, None, None), (None, "no id at all", "en", "s", 12), (-5, "a b c d e f g h", None, None, 0)]
    return rows


def edge_docs(spark, clashing: bool = False):
    df = spark.createDataFrame(edge_rows(), DOCS).repartition(3)
    if clashing:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES])
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def plain(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def roots(n: int, pairs) -> list[int]:
    """Smallest place that each of ``n`` places reaches."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
