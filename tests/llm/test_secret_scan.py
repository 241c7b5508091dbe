import hashlib
import random
import re

from leadloom.llm import secret_scan as S

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    t = text or ""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[0], x[2]))


def corpus(seed=1, n=300):
    rnd = random.Random(seed)
    code = lambda chars, k: "".join(rnd.choices(chars, k=k))
    texts = []
    for i in range(n):
        words = ["".join(rnd.choices("abcdefghijklmnoprstuvwxyz", k=rnd.randrange(2, 14))) for _ in range(60)]
        words[3], words[9] = f"{rnd.randrange(1900, 2030)}-01-12T10", f"{rnd.randrange(10, 250)}.{rnd.randrange(10, 250)}.10.20"
        if i % 2:
            words[20] = rnd.choice(["password=", "Token: '", 'API_KEY="', "secret = "]) + code("0123456789abcdef", 18)
        if i % 3 == 0:
            words[30] = "AKIA" + code("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)
        if i % 4 == 0:
            words[40] = code("0123456789abcdef", 40)
        texts.append(" ".join(words))
    return texts


ODD = [None, "", "password=short", "PASSWD:'abcdefgh\"", "paſſword=abcdefgh1", "toKen=abcdefgh1", "AKIAAKIAAKIAAKIA", "é\U0001f600 secret=abcdefgh secret=12345678",
       "a" * 40, "0" * 31, "f" * 1_000_000 + "g", "token=" + "9" * 100_000, "passwordpassword==x", "token:token=abcdefgh"]


def test_base_spans_against_brute_force(docs, clashing):
    texts = ODD + corpus(7, 60)
    df = docs(list(enumerate(texts)))
    model = S.fit(df)
    rows = {r.doc_id: r for r in S.digests(S.scan(clashing(df), model)).collect()}
    names = ("assign", "access", "hex")
    for i, t in enumerate(texts):
        want = brute(t)
        listed = [f"{names[k]}:{s}:{e}" for s, e, k in want]
        r = rows[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, _, k in want) for x in range(3)), i
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("learned")] == listed
        starts = [int(x.split(":")[1]) for x in r.spans.split(",") if x]
        assert starts == sorted(starts)


def test_learned_spans_find_bare_credentials(docs):
    df = docs(list(enumerate(corpus())))
    model = S.fit(df)
    rnd = random.Random(99)
    bare = ["".join(rnd.choices("0123456789abcdef", k=20)) for _ in range(40)]
    words = [f"{w}{rnd.randrange(10)}ing" for w in ("building", "reading", "thinking", "walking") * 10]
    texts = [f"here is {b} alone" for b in bare] + [f"here is {w} alone" for w in words]
    rows = S.scan(docs(list(enumerate(texts))), model).collect()
    hit = {r.doc_id: [s for s in r.spans if s.kind == "learned"] for r in rows}
    assert sum(bool(hit[i]) for i in range(40)) >= 36
    assert sum(bool(hit[i]) for i in range(40, 80)) <= 4
    assert all(texts[i][s.start:s.stop] == bare[i] for i in range(40) for s in hit[i])


def test_merging_generalises():
    auto = S.infer({"".join(random.Random(i).choices("ab", k=12)): 1 for i in range(200)})
    table = S.table(auto)
    assert len(table.steps) <= 4
    assert table.per_char("ab" * 6) > table.per_char("ac" * 6) + 1


def test_sample_does_not_depend_on_partitions(docs):
    df = docs(list(enumerate(corpus(3, 200))))
    a = {tuple(r) for r in S.examples(df.repartition(1), values=20, ordinary=30).collect()}
    b = {tuple(r) for r in S.examples(df.repartition(7), values=20, ordinary=30).collect()}
    assert a == b and len(a) == 90


def test_without_credentials(docs):
    for rows in ([], [(1, None)], [(1, "plain words only"), (1, "plain words only")]):
        df = docs(rows)
        assert [r.spans for r in S.scan(df, S.fit(df)).collect()] == [[]] * len(rows)


def test_bare_credentials_in_the_fitted_corpus_do_not_hide_others(docs):
    rnd = random.Random(5)
    bare = ["".join(rnd.choices("0123456789abcdef", k=20)) for _ in range(60)]
    texts = [f"{t} {bare[i // 5]} end" if i % 5 == 0 else t for i, t in enumerate(corpus())]
    df = docs(list(enumerate(texts)))
    found = {r.doc_id: [texts[r.doc_id][s.start:s.stop] for s in r.spans if s.kind == "learned"] for r in S.scan(df, S.fit(df)).collect()}
    assert sum(bare[i // 5] in found[i] for i in range(0, 300, 5)) >= 54
    assert sum(v not in bare for vs in found.values() for v in vs) <= 0.01 * 300 * 60


def test_credentials_of_letters_only(docs):
    rnd = random.Random(6)
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    code = lambda chars, k: "".join(rnd.choices(chars, k=k))
    df = docs([(i, f"{t} password={code(mixed + '0123456789', 20)} end") for i, t in enumerate(corpus())])
    bare = [code(mixed, 24) for _ in range(40)]
    words = [code("abcdefghijklmnoprstuvwxyz", 12) for _ in range(40)]
    texts = [f"here is {w} alone" for w in bare + words]
    hit = {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in S.scan(docs(list(enumerate(texts))), S.fit(df)).collect()}
    assert sum((8, 32) in hit[i] for i in range(40)) >= 36
    assert sum(bool(hit[i]) for i in range(40, 80)) <= 4


def test_every_value_and_token_counts(docs, monkeypatch):
    """More values than the old samples held; sums of a task passed on in pieces."""
    rnd = random.Random(8)
    values = ["".join(rnd.choices("0123456789abcdef", k=12)) for _ in range(1300)]
    values[0] = "Z" * 300
    words = ["".join(rnd.choices("abcdefgh", k=9)) for _ in range(4000)]
    texts = [f"password={v} {' '.join(words[3 * i:3 * i + 6])}" for i, v in enumerate(values)] * 2
    found = S.tokens(docs(list(enumerate(texts))))
    counts = S.step_counts(found)
    want = S.Counter((v[max(0, i - 2):i], v[i:i + 1]) for v in set(values) for i in range(len(v) + 1) if (v[max(0, i - 2):i], v[i:i + 1]) not in
                     {(v[max(0, j - 2):j], v[j:j + 1]) for j in range(i)})
    code = lambda c: S.ALPHABET.index(c) + 1 if c else 0
    place = lambda before, c: (code(before[:-1]) * S.SYMBOLS + code(before[-1:])) * S.SYMBOLS + code(c)
    assert {int(k): int(counts[0][k]) for k in counts[0].nonzero()[0]} == {place(*k): n for k, n in want.items()}
    held = S.Counter(w for t in texts for w in set(t.split()[1:]))
    # A word in one text only, copies of the text included.
    plain = {r.value: (r.n, r.single) for r in found.where("kind = 3").collect()}
    texts_of = S.Counter(w for t in set(texts) for w in set(t.split()[1:]))
    assert plain == {w: (n, texts_of[w] == 1) for w, n in held.items()}
