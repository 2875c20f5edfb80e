import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quernel.llm import range_coder, token_output
from quernel.llm.common import documents

PATH = public_tokenizers.path(token_output.VOCABULARY)


def library():
    """As the contract calls it, with nothing set."""
    return Tokenizer.from_file(PATH)


def expected(rows):
    """[(doc_id, start, n_tokens, ids_crc32)] with the library alone; rows are sorted."""
    t, start, out = library(), 0, []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("stripe", [token_output.STRIPE_IDS, 30000])
def test_round_trip_of_a_table(spark, small, tmp_path, stripe):
    docs = documents(spark, small)
    token_output.write_tokens(docs, f"{tmp_path}/t", PATH, stripe)
    got = sorted(map(tuple, token_output.read_tokens(spark, f"{tmp_path}/t").collect()))
    assert got == expected(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_edges(spark, tmp_path):
    odd = ["", None, " ", "  ", "a  b", "a \n b", " a", "a ", "it's we'll", "x  y", "<|endoftext|> a", "é  ü", "1 2,3 \t"]
    rows = [(i, t, "x") for i, t in enumerate([*odd, "w " * 30000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = sorted(map(tuple, token_output.round_trip(df, PATH).collect()))
    assert got == expected([r[:2] for r in rows])
    assert token_output.round_trip(df.limit(0), PATH).count() == 0
    again = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id bigint, text string")
    got = token_output.round_trip(again, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.start) for r in got) == [(0, 2, 0), (1, 2, 2), (1, 2, 4)]


def test_pieces_are_encoded_as_the_whole():
    draw = np.random.default_rng(4)
    parts = ["a", "The", " ", " ", "\n", "'s", "12", ",", "é", "中", " ", "\t", "!!"]
    texts = ["".join(draw.choice(parts, 30)) for _ in range(2000)]
    want = [t.ids + [0] for t in library().encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in token_output.Encoder(PATH).encode(texts)] == want


@pytest.mark.parametrize("n", [0, 1, 65, 700, 4097])
def test_coder_round_trip(n):
    draw = np.random.default_rng(n)
    kinds = [draw.zipf(1.3, n) % 50257, draw.integers(0, 65536, n), np.zeros(n, int), np.arange(n) % 7]
    for ids in kinds if n < 1000 else kinds[:1]:
        assert (range_coder.decode(range_coder.encode(ids)) == ids).all()


def test_coder_uses_what_repeats():
    phrase = np.random.default_rng(1).integers(0, 50257, 200)
    assert len(range_coder.encode(np.tile(phrase, 10))) < 2000 * 2 / 4


def test_size_comes_near_the_entropy():
    """A source with three kinds of followers: in one block, learning included, within 1.4 of its entropy."""
    draw, states = np.random.default_rng(7), 50
    follow, ids = draw.integers(0, states, (states, 2)), [0]
    for turn in draw.random(8190):
        ids.append(int(follow[ids[-1], int(turn < 0.2)]) if turn < 0.95 else int(draw.integers(states)))
    bits = -0.75 * np.log2(0.75) - 0.2 * np.log2(0.2) - 0.05 * np.log2(0.05 / states)
    size = len(range_coder.encode(np.array(ids), 8191))
    assert size < 1.4 * bits * len(ids) / 8
    assert size < len(zlib.compress(np.array(ids, "<u2").tobytes(), 9))


def test_real_texts_take_less_than_with_zlib(spark, small):
    texts = [r.text or "" for r in documents(spark, small).orderBy("doc_id").collect()]
    ids = np.concatenate(token_output.Encoder(PATH).encode(texts))
    assert len(range_coder.encode(ids)) < len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_the_parts_of_the_interval_are_one():
    """Candidates, other known ids and new ids share out the sum of all weights; no known id has two places."""
    ids = np.random.default_rng(3).zipf(1.4, 4000) % 300
    model, slots = range_coder._Model(1, len(ids)), set()
    for t, now in enumerate(ids.reshape(-1, 1)):
        if t in range_coder._recounts(len(ids)):
            model.count_anew(t)
        model.predict()
        assert (model.mass >= 0).all()
        open_orders = np.array([model.most[0] > 0, model.most[1] > 0, model.places > 0, [True]])
        assert model.total == (model.weight * open_orders).sum() << range_coder._SCALE
        known = np.arange(1, int(model.known[0]) + 1)
        rest = np.setdiff1d(known, model.candidate)
        lanes = np.zeros(len(rest), int)
        start, size = model.run(lanes, rest)
        order = np.argsort(start)
        assert (np.cumsum(size[order]) - size[order] == start[order]).all() and size.sum() == model.others[0]
        assert (model.at_place(lanes, start) == rest).all() and (model.mass[4] > 0 or not len(rest))
        number = model.number[model.by_id + now].astype(np.int64)
        at = np.flatnonzero((model.candidate[:, 0] == number) & (number > 0))
        slot = at if len(at) else np.where(number > 0, range_coder._REST, range_coder._NEW)
        slots.add(int(slot[0]))
        model.learn(now, number, slot)
    assert slots == set(range(6))


def test_a_damaged_block_is_an_error():
    data = bytearray(range_coder.encode(np.arange(900) % 300))
    data[-20] ^= 255
    with pytest.raises(ValueError):
        range_coder.decode(bytes(data))


@pytest.mark.parametrize("work", [range_coder.encode, range_coder.decode])
def test_a_block_takes_no_table_of_all_ids(work):
    """Two workers share an executor: with a number for each of 65,536 ids a block took 131 kB more."""
    ids, blocks = np.random.default_rng(5).zipf(1.3, 64 * 4096) % 50257, 64
    given = ids if work is range_coder.encode else range_coder.encode(ids, 4096)
    tracemalloc.start()
    work(*[given, 4096][: 2 if work is range_coder.encode else 1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / blocks < 300_000


def test_words_are_encoded_as_the_whole():
    """Cuts at signs and line ends, beside letters and spaces of many kinds, and the added token."""
    draw = np.random.default_rng(6)
    parts = ["a", "The", " ", " ", "\n", ".\n", "'s", "'ll", "12", ",", "_", "-", "é", "½", "²", "Ⅷ", "К", "中", "́"]
    parts += ["\t", "\x1c", " ", "　", "$", "<", "|", ">", "<|endoftext|>", "x"]
    texts = ["".join(draw.choice(parts, n)) for n in draw.integers(0, 25, 5000)]
    want = [t.ids + [0] for t in library().encode_batch(texts, add_special_tokens=False)]
    encoder = token_output.Encoder(PATH)
    got = [x.tolist() for at in range(0, 5000, 500) for x in encoder.encode(texts[at : at + 500])]
    assert got == want
    assert encoder.encode([]) == []


def test_a_partition_does_not_end_with_a_short_stripe(spark, tmp_path):
    rows = [(i, "a b c d e f g") for i in range(460)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    token_output.write_tokens(df, f"{tmp_path}/t", PATH, 800)
    ids = [r.ids for r in spark.read.parquet(f"{tmp_path}/t").orderBy("part", "stripe").collect()]
    assert sum(ids) == 460 * 8 and min(ids) >= 400 and max(ids) < 1200 + 8
    got = sorted(map(tuple, token_output.read_tokens(spark, f"{tmp_path}/t").collect()))
    assert got == expected(rows)
