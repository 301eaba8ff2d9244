"""Rows that every operator must take: nulls, blanks, repeats, long texts, clashing names."""

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, shard int, n_bytes string, "
    "block string, slot string, spans int, fp string, h string, row string, label string, class string, rejected int, "
    "lang_pred int, n_words string, n_entities string, id string, tag string, count string, key string, bytes string, "
    "`a.b` string, __x int, __bytes string, __row string, `c 0` string, c1 string, place string"
)
PROSE = "The quick brown fox jumps over the lazy dog and runs to the river with all of its friends.\nThen they sleep in the sun. "
TEXTS = [
    (1, PROSE), (1, PROSE), (2, None), (3, ""), (4, " \t\n\r "), (None, PROSE + "More."), (None, None), (5, "a"), (5, "b"),
    (6, "émigré ☃ \U0001f600 ſecret İstanbul"), (7, "word " * 40_000), (8, "x" * 100_000), (9, "\x00\x01 <b>&amp;\n\n|"),
]


def edge_rows(spark, texts=TEXTS):
    rows = [(i, t, "en" if k % 2 else None, "s" if k % 3 else None, None, *["z" if f.split()[-1] == "string" else 7 for f in SCHEMA.split(", ")[5:]]) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def read(spark, name="documents"):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def plain(df):
    return sorted(tuple(r) for r in df.collect()) if df.columns else []
