from random import Random

from quernel.llm import licenses


def matches(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, matches int")
    rows = sorted(licenses.scan(df).collect(), key=lambda r: r.doc_id)
    return [[(m.license, round(m.dice, 3), m.first_line, m.n_lines) for m in r.matches] for r in rows]


def test_lines_and_paragraphs(spark):
    notice = licenses.TEMPLATES["BSD-3-Clause"]
    half = notice.split()
    wrapped = " ".join(half[:10]) + "\n" + " ".join(half[10:])
    got = matches(spark, [f"x\n\n{wrapped}\n \nlicensed UNDER the apache license version 2 0", notice.replace("code", "files")])
    assert got[0] == [("Apache-2.0", 1.0, 5, 1), ("BSD-3-Clause", 1.0, 2, 2)]
    assert got[1] == [("BSD-3-Clause", round(2 * 17 / 38, 3), 0, 1)]


def test_pruning_loses_nothing():
    free, bound = licenses.Matcher(licenses.TEMPLATES, 1e-9), licenses.Matcher(licenses.TEMPLATES, 0.8)
    for text in licenses.TEMPLATES.values():
        for cut in range(0, len(text), 15):
            part = text[cut:].encode()
            assert list(bound.compare(part)) == [x for x in free.compare(part) if x[1] >= 0.8]


def test_edges(spark):
    texts = [None, "", "\n\n", "mit", "word " * 50000, "Licensed under CC BY-NC 4.0.\n" * 2]
    assert [len(m) for m in matches(spark, texts)] == [0, 0, 0, 0, 0, 2]
    assert matches(spark, texts[:0] or [None])[0] == []


BSD = """// Copyright 2020 Some Authors
//
// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are
// met:
//
//    * Redistributions of source code must retain the above copyright
// notice, this list of conditions and the following disclaimer.
int main() { return 0; }"""


def test_notices_inside_other_text(spark):
    words = licenses.TEMPLATES["GPL-3.0"].split()
    code = ["int first, second, third; // with some words of its own"] * 5
    header = "\n".join([*code, "//", *("// " + " ".join(words[i : i + 9]) for i in range(0, 45, 9)), "//", *code])
    inline = "Some words before. " + licenses.TEMPLATES["BSD-3-Clause"] + " And then many words after it. " * 3
    got = matches(spark, [header, BSD, inline, header + "\n\n" + header])
    assert [m for m in got[0] if m[0] == "GPL-3.0"] == [("GPL-3.0", 1.0, 6, 5)]
    assert got[1] == [("BSD-conditions", 1.0, 2, 3)]
    assert got[2] == [("BSD-3-Clause", 1.0, 0, 1)]
    assert [m[2] for m in got[3] if m[0] == "GPL-3.0"] == [6, 24]


def test_windows_against_every_window():
    """No anchor or count leaves out a window that reaches the bound."""
    from collections import Counter

    matcher = licenses.Matcher(licenses.TEMPLATES, 0.8)
    random = Random(1)
    for size, name, template in matcher.templates[:12]:
        words = licenses.TEMPLATES[name].encode().translate(licenses._TABLE).split()
        for share in (0.0, 0.05, 0.1, 0.2):
            mine = [w if random.random() >= share else b"other" for w in words[: random.randint(len(words) * 2 // 3, len(words))]]
            text = b" ".join([b"before"] * random.randint(0, 9) + mine + [b"after"] * random.randint(0, 9))
            pairs = licenses.bigrams(text)
            width = min(size, len(pairs))
            every = [
                2 * (Counter(pairs[i : i + width]) & template).total() / (width + size)
                for i in range(len(pairs) - width + 1)
            ]
            best = max((d for n, d, _, _ in matcher.windows(text) if n == name), default=None)
            assert best == (max(every) if max(every) >= 0.8 else None)


def test_full_texts():
    matcher = licenses.Matcher(licenses.TEMPLATES | licenses.FULL_TEXTS, licenses.BOUND)
    for name, text in licenses.FULL_TEXTS.items():
        lines = text.splitlines()
        for inside in (lines, [f" * {line}" for line in lines]):
            found = matcher.matches("\n".join(["Words before.", "", *inside, "", "Words after."]).encode())
            assert any(license == name and dice >= 0.8 for license, dice, _, _ in found), name
    wrapped = matcher.matches(b"\n".join(licenses.TEMPLATES["MIT-grant"].encode().split(b",")))
    assert ("MIT-grant", 1.0) in [m[:2] for m in wrapped]


def test_full_text_is_scanned(spark):
    found = matches(spark, [licenses.FULL_TEXTS["MIT-text"]])[0]
    assert {"MIT-text", "MIT-grant"} <= {m[0] for m in found}


def test_best_license_of_a_place():
    matcher = licenses.Matcher(licenses.TEMPLATES | licenses.FULL_TEXTS, licenses.BOUND)
    names = {}
    for name in ("GPL-2.0", "GPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MIT"):
        names[name] = {m[0] for m in matcher.matches(licenses.FULL_TEXTS[f"{name}-text"].encode())}
        assert f"{name}-text" in names[name]
    assert not any(n.startswith(("AGPL", "LGPL", "GPL-3")) for n in names["GPL-2.0"])
    assert not any(n.startswith("GPL-2") for n in names["GPL-3.0"])
    assert "BSD-3-Clause-text" not in names["BSD-2-Clause"] and "BSD-2-Clause-text" not in names["BSD-3-Clause"]
    for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
        line = licenses.TEMPLATES[name]
        assert [m[0] for m in matcher.matches(line.encode())] == [name]
        assert [m[0] for m in matcher.matches(f"some words before {line} and after".encode())] == [name]


def test_spans_as_brute_force():
    random = Random(4)
    for _ in range(200):
        spans, plain = licenses._Spans(), []
        for _ in range(30):
            at = random.randrange(100)
            stop = at + random.randrange(1, 12)
            hit = any(a < stop and at < b for a, b in plain)
            assert spans.meets(at, stop) == hit
            best = any(2 * (min(stop, b) - max(at, a)) > max(stop - at, b - a) for a, b in plain)
            assert spans.same_place(at, stop, 1.0) == best and not spans.same_place(at, stop, 1.5)
            if not hit:
                spans.add(at, stop)
                plain.append((at, stop))


def test_paragraph_places():
    matcher = licenses.Matcher(licenses.TEMPLATES, licenses.BOUND)
    text = b"\n \na\nb\n\n\n\nc\n\nd\ne\nf"
    assert [s for s in matcher.segments(text) if s[1] > 1] == [(2, 2, b"a\nb"), (9, 3, b"d\ne\nf")]


def test_time_is_linear_in_repeated_notices():
    import time

    matcher = licenses.Matcher(licenses.TEMPLATES | licenses.FULL_TEXTS, licenses.BOUND)
    notice = b"and so it is Released under the MIT License. "
    took = []
    for n in (2000, 16000):
        start = time.process_time()
        assert len(matcher.matches(notice * n)) == n
        took.append(time.process_time() - start)
    assert took[1] < 25 * took[0]
