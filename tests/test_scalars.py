import datetime as dt

from pyspark.sql import functions as F

from basalt.functions import scalars as S


def _one(spark, col, rows, schema="v long"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_human_size_matches_python_format(spark):
    sizes = [0, 1, 512, 1023, 1024, 1536, 256 * 1024 // 1024 * 1, 1024 * 1024 - 1, 262144, 256, 5 * 1024 ** 3,
             3 * 1024 ** 4, 1024 ** 2 + 1024 ** 2 // 4]

    def py(n):
        if n == 0:
            return "0 B"
        x = float(n)
        for unit in ["B", "KB", "MB", "GB"]:
            if x < 1024:
                return f"{x:.1f} {unit}"
            x /= 1024
        return f"{x:.1f} TB"

    got = _one(spark, S.human_size("v"), [(s,) for s in sizes])
    assert got == [py(s) for s in sizes]


def test_human_size_tie_rounds_to_even(spark):
    # 0.25 MB is an exact binary tie: Python prints 0.2, Java's half-up would print 0.3
    assert _one(spark, S.human_size_short("v"), [(262144,)]) == ["256.0KB"]
    assert _one(spark, S.human_size("v"), [(1024 ** 2 // 4 * 1024,)]) == ["256.0 MB"]
    assert _one(spark, S.human_size("v"), [(int(1024 ** 3 * 0.25),)]) == ["256.0 MB"]
    assert _one(spark, S.human_size("v"), [(int(1024 ** 4 * 0.25),)]) == ["256.0 GB"]
    assert _one(spark, S.human_size_short("v"), [(int(1024 ** 2 * 2.25),)]) == ["2.2MB"]


def test_extension_type_and_name(spark):
    rows = [("a/b/c.JSONL",), ("noext",), ("x/y.tar.gz",), ("d/e.metadata",), ("f.json",)]
    df = spark.createDataFrame(rows, "k string")
    out = df.select(S.basename("k"), S.extension("k"), S.type_label("k")).collect()
    assert [tuple(r) for r in out] == [("c.JSONL", "jsonl", "OTRO"), ("noext", "sin_ext", "OTRO"),
                                       ("y.tar.gz", "gz", "OTRO"), ("e.metadata", "metadata", "METADATA"),
                                       ("f.json", "json", "JSON")]


def test_truncation_and_previews(spark):
    df = spark.createDataFrame([("abcdefghijklmnop", "x" * 120)], "n string, b string")
    r = df.select(S.truncate_head("n", 10), S.truncate_tail("n", 12), S.text_preview("b", 100)).first()
    assert r[0] == "abcdef..."
    assert r[1] == "...ijklmnop"
    assert r[2] == "x" * 100 + "..."


def test_timestamp_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    assert df.select(S.timestamp_text("t"), S.timestamp_text("t", True)).first() == ("2024-01-02 03:04:05",
                                                                                     "2024-01-02 03:04")
    assert F is not None


def test_covering_range_rounds_up_to_periods():
    import datetime as dt
    from basalt.operators.metrics import covering_range
    d = dt.datetime
    assert covering_range(d(2024, 1, 30, 11, 50), d(2024, 1, 30, 12, 0)) == (d(2024, 1, 30, 11, 50), d(2024, 1, 30, 12, 0))
    assert covering_range(d(2024, 1, 30, 11, 51, 0, 1), d(2024, 1, 30, 12, 0, 0, 5)) == \
        (d(2024, 1, 30, 11, 55), d(2024, 1, 30, 12, 5))
