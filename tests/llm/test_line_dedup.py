from pyspark.sql import types as T

from varloom.llm import line_dedup

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("runs", T.StringType()),
    ]
)
BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(docs):
    first = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANK))
            if len(key) >= 10:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(lower(x.strip(BLANK)), doc) >= doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_against_brute_force(spark):
    shared = "A shared line of text"
    docs = [
        (1, f"{shared}\nown line number one\n\n{shared.upper()}"),
        (2, f"  {shared}\t\nshort\nown line number two\n{shared}"),
        (3, None),
        (4, ""),
        (5, shared),
        (6, "short\nÉCLAIR LINE LONG\n"),
        (7, "éCLAIR LINE LONG\nÉclair line long"),
        (8, "\n".join(f"{shared} {i % 7}" for i in range(3000))),
    ] + [(100 + i, f"hot line in every one\n{i} unique line here\nhot line in every one") for i in range(400)]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOC)
    got = sorted((r._id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup(frame).collect())
    assert got == brute(docs)


def test_bitmap_is_run_length_coded(spark):
    frame = spark.createDataFrame([(1, "a shared line", "", ""), (2, "own text 12345\na shared line\nA shared line \nz", "", "")], DOC)
    row = line_dedup.dedup(frame).filter("_id = 2").first()
    assert [tuple(r) for r in row.keep_runs] == [(0, 1), (3, 1)]


def test_repeated_rows_null_ids_and_no_rows(spark):
    line = "the very same line"
    frame = spark.createDataFrame([(2, line, "", ""), (2, line, "", ""), (None, line, "", ""), (2, "other " + line, "", "")], DOC)
    got = sorted((r._id, r.n_dropped) for r in line_dedup.dedup(frame).collect())
    assert got == [(2, 0), (2, 0), (2, 0), (line_dedup.keyed.__globals__["NO_ID"], 1)]
    assert line_dedup.dedup(frame.limit(0)).count() == 0
