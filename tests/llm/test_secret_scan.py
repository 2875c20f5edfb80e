import random
import re

from quernel.llm import secret_scan

ASSIGN = re.compile(secret_scan.ASSIGN)


def base(text):
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort(key=lambda x: (x[1].start(), secret_scan.KINDS.index(x[0])))
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found)


def scanned(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, kind int")
    return [(r.base, r.spans) for r in sorted(secret_scan.find_secrets(df).collect(), key=lambda r: r.doc_id)]


def test_base_as_brute_force(spark):
    draw = random.Random(1)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ": ", '"', "'", " ", "AKIA", "ABCDEF0123456789", "0a1b2c3d",
             "deadbeefdeadbeef", "é", "word", "\n", "secret", "x" * 12, "short", "/+", "."]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(25))) for _ in range(300)]
    got = scanned(spark, texts)
    assert [b for b, _ in got] == [base(t) for t in texts]
    assert all(set(b.split(",")) <= set(s.split(",")) for b, s in got if b)


def test_weak_parts_are_reported_together_only(spark):
    identifier, blob, url = "AKIA12345678", "aB3" * 8, "https://example.org/x"
    texts = [
        f"é {identifier} and {blob} at {url}",
        f"{identifier} alone", f"{blob} alone", f"{url} alone", f"{blob} {url}", f"{identifier} {url}",
        f"{identifier} {'x ' * 200} {blob} {url}",
        f"{identifier} password=abcdef",
        f"AKIA{'A' * 16} password=abcdef",
    ]
    spans = [s for _, s in scanned(spark, texts)]
    assert spans == [
        "id:2:14,blob:19:43,endpoint:47:68", "", "", "", "", "", "", "id:0:12,assign:13:28", "access:0:20,assign:21:36",
    ]


def spans_by_hand(text):
    """All spans by plain loops over all pairs of parts."""
    found = [("assign", m.start(), m.end(), len(m[2])) for m in ASSIGN.finditer(text)]
    found += [("access", m.start(), m.end(), len(m[0])) for m in re.finditer(secret_scan.ACCESS, text)]
    found += [("hex", m.start(), m.end(), 0) for m in re.finditer(secret_scan.HEX, text)]
    found += [("id", m.start(), m.end(), 0) for m in re.finditer(secret_scan.IDENTIFIER, text)]
    found += [("endpoint", m.start(), m.end(), 0) for m in re.finditer(secret_scan.ENDPOINT, text)]
    mixed = [m for m in re.finditer(secret_scan.BLOB, text) if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))]

    def pick(kind, least=0, most=10**9):
        return {f[:3] for f in found if f[0] == kind and least <= f[3] <= most}

    base = pick("assign", 12) | pick("access", 18) | pick("hex")
    weak_ids = {("id", a, b) for _, a, b in pick("access", 8, 17)} | pick("id")
    short = pick("assign", 6, 11)
    blobs = {("blob", *m.span()) for m in mixed if all(m.end() <= a or b <= m.start() for _, a, b in base | weak_ids)}
    ids = {f for f in base if f[0] == "access"} | weak_ids
    secrets = {f for f in base if f[0] != "access"} | short | blobs
    assigned, ends = pick("assign", 12) | short, pick("endpoint")

    def near(x, parts):
        return any(0 <= max(x[1], y[1]) - min(x[2], y[2]) <= secret_scan.SCOPE for y in parts)

    added = {x for x in weak_ids if near(x, secrets)} | {x for x in short | blobs if near(x, ids)}
    added |= {x for x in short if near(x, ends)}
    added |= {x for x in ends if near(x, assigned) or near(x, ids) and near(x, secrets)}
    order = sorted(base | added, key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def test_links_as_brute_force(spark):
    draw = random.Random(2)
    parts = ["client_id=", "user: ", "abc.def", "password=", "hunter22", "abcdef", "https://db.example.org/x", "AKIA12345678",
             "aB3" * 8, "0a" * 10, "AKIA" + "Z" * 16, " ", " ", "é" * 30, "word " * 15, "x " * 90, "x" * 250, "\n"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(2, 30))) for _ in range(400)]
    got = [s for _, s in scanned(spark, texts)]
    assert got == [spans_by_hand(t) for t in texts]
    assert sum(s != base(t) for s, t in zip(got, texts)) > 100


def test_identifiers_and_endpoints(spark):
    url = "https://db.example.org/x"
    far = " x" * 100
    texts = [
        f"client_id=abc123def password=hunter22 {url}",
        f"password=hunter22 {url}", "client_id=abc123def alone", "password=hunter22 alone",
        "client_id=0123456789abcdef",  # its own value is no secret beside it
        "login: someone " + "token=" + "a-" * 200 + f" {url}",
        f"password=hunter22{far}{url}", f"password=hunter22 {far}{url}",
    ]
    assert [s for _, s in scanned(spark, texts)] == [
        "id:0:19,assign:20:37,endpoint:38:62", "assign:0:17,endpoint:18:42", "", "", "hex:10:26",
        "id:0:14,assign:15:421,endpoint:422:446", "assign:0:17,endpoint:217:241", "",
    ]


def test_sql_says_the_same(spark):
    """The links in SQL, on a table in which they add spans."""
    import duckdb

    from quernel.llm.queries import ORACLES

    draw = random.Random(3)
    parts = ["client_id=abc", "password=hunter22", "https://a.org", "AKIA12345678", "aB3" * 8, "0a" * 10, "é" * 90, "x " * 40]
    texts = [" ".join(draw.choice(parts) for _ in range(draw.randrange(9))) for _ in range(100)] + [None]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    cursor = db.execute(ORACLES["op9_secret_scan"])
    names = [d[0] for d in cursor.description]
    rows = sorted((dict(zip(names, r)) for r in cursor.fetchall()), key=lambda r: r["doc_id"])
    assert [r["spans"] for r in rows] == [s for _, s in scanned(spark, texts)]


def test_edges(spark):
    texts = [None, "", "token: " + "a" * 40, "f" * 100_000, "AKIA " * 20_000]
    got = scanned(spark, texts)
    assert got[0] == got[1] == ("", "")
    assert got[2][0] == "assign:0:47,hex:7:47" and got[3][0] == "hex:0:100000" and got[4] == ("", "")
    again = spark.createDataFrame([(1, "f" * 20), (1, "f" * 20), (None, "x")], "doc_id bigint, text string")
    assert sorted(r.spans for r in secret_scan.find_secrets(again).collect()) == ["", "hex:0:20", "hex:0:20"]
    assert secret_scan.find_secrets(again.limit(0)).count() == 0
