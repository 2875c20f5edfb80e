import brute

from quernel.llm import decontaminate
from quernel.llm.common import documents
from quernel.sources import load_table


def found(docs, items, **settings):
    out = {}
    for r in decontaminate.find(docs, items, **settings).collect():
        hit = sum(s.last_word - s.first_word + 1 for s in r.spans)
        out[r.doc_id] = (r.n_words, hit, r["items"])
    return out


def test_one_automaton_and_several_agree_with_brute_force(spark, small):
    docs, items = documents(spark, small), load_table(spark, "benchmark", folder=small)
    expected = brute.contaminated({r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in items.collect()})
    assert found(docs, items) == expected
    assert found(docs, items, block_bytes=2000) == expected


def test_places_in_the_original_text(spark):
    item = "Où est-il? Une très longue phrase, de plus de dix mots"
    text = "Début -- " + item.replace(" ", "  ").upper().replace("Ù", "ù").replace("È", "è") + " fin"
    docs = spark.createDataFrame([(1, text, "x")], "doc_id bigint, text string, items string")
    items = spark.createDataFrame([(7, item), (7, item), (8, "Début"), (9, None), (None, "fin")], "item_id bigint, text string")
    r = decontaminate.find(docs, items).first()
    assert r["items"] == ["7", "8", "None"]
    assert [text[s.start : s.end] for s in r.spans] == [text]
    only = decontaminate.find(docs, items.filter("item_id = 7")).first()
    assert [text[s.start : s.end] for s in only.spans] == [text[9:-4]]


def test_edges(spark):
    texts = [None, "", "?!", "a b", "A-B", "a b c " * 30000, "ab"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, "a b"), (None, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b"), (2, ""), (3, "c a b c a b c a b c a")], "item_id bigint, text string")
    rows = decontaminate.find(docs, items).collect()
    assert len(rows) == 9
    expected = brute.contaminated(dict(enumerate(texts)), {1: "a b", 3: "c a b c a b c a b c a"})
    got = found(docs.filter("doc_id IS NOT NULL"), items)
    assert got == expected
    assert all(n[1:] == (0, []) for n in found(docs, items.limit(0)).values())
    assert found(docs.limit(0), items) == {}
