from collections import Counter, defaultdict

import brute
import corpus_pipeline as pipeline
from oracle import connect

from quernel.llm.common import documents
from quernel.llm.queries import ORACLES


def test_stages_as_brute_force(spark, small):
    """Each stage keeps what a plain version of it keeps; the last one obeys its law."""
    start = documents(spark, small)
    docs = {r.doc_id: r for r in start.collect()}
    con = connect(small)
    kept = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({ORACLES['op4_quality_rules']})").fetchall() if k}
    items = dict(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    frame, names = start, [n for n, _ in pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "benchmark decontamination", "source mix", "sharding"]
    for name, stage in pipeline.STAGES[:-1]:
        frame = pipeline.materialize(stage(spark, frame, small), "test")
        assert frame.columns == start.columns
        got = Counter(r.doc_id for r in frame.collect())
        if name == "near duplicates":
            near = brute.near_duplicates({i: docs[i].text for i in kept}, pipeline.NEAR)
            kept = {i for i in kept if near[i][2]}
        elif name == "benchmark decontamination":
            found = brute.contaminated({i: docs[i].text for i in kept}, items)
            kept = {i for i in kept if not found[i][1]}
        elif name == "source mix":
            mixed = brute.mix({i: (docs[i].text, docs[i].source) for i in kept})
            kept = Counter({i: r[3] // r[0] for i, r in mixed.items() if r[3]})
        assert got == Counter(kept)
    rows = pipeline.STAGES[-1][1](spark, frame, small).collect()
    assert Counter(r.doc_id for r in rows) == kept
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = pipeline.run(spark, small).collect()
    assert sorted(map(str, whole)) == sorted(map(str, rows))


def test_odd_rows_pass_all_stages(spark, small):
    rows = [
        (1, None, None, None, None), (None, "", "en", "s", 0), (None, "plain words " * 30, "en", "s", 5),
        (2, "one two three four five six seven eight nine ten eleven", "en", None, 1),
        (2, "one two three four five six seven eight nine ten eleven", "en", None, 1),
        (3, "One two three four five six seven eight nine ten eleven", "xx", "s", 2),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df = df.selectExpr(
        "*", "1 AS kept", "'x' AS size", "2 AS text_hash", "3 AS gone_id", "4 AS _gone_hash", "5 AS again", "6 AS _PLACE",
        "7 AS mix_copy", "8 AS _copies",
    )
    for frame in (df, df.limit(0)):
        for name, stage in pipeline.STAGES:
            frame = pipeline.materialize(stage(spark, frame, small), "odd")
            if name != "sharding":
                assert frame.columns == df.columns
            if name == "near duplicates":
                assert frame.filter("doc_id IS NOT NULL").count() <= 1
