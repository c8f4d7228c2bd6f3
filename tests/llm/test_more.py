"""Whitening, piece encoding and the filter audit against exact fractions, the library and SQL."""

import hashlib
import itertools
import random
import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from floeframe.llm import filter_audit, piece_bpe, queries, whitening

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, component string, y string, n string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, digest string, mask string, kind string"
LABELS = "doc_id long, quality int, toxic int, kind string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "n") for i, v in rows], VECTORS).repartition(3)


def whole(v, width):
    x = [min(max(int(np.floor(np.float64(c) * 64)), -(2**63)), 2**63 - 1) + whitening.SHIFT for c in v]
    return x + [whitening.SHIFT] * (width - len(x))


def by_brute_force(rows):
    """(n, deviation by id, whitened by id and component, explained) from fractions."""
    used = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in used)
    xs = [(i, whole(v, width)) for i, v in used]
    fit = sorted({tuple(x) for _, x in xs})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[float(sum((Fraction(x[a]) - Fraction(s[a], n)) * (Fraction(x[b]) - Fraction(s[b], n)) for x in fit) / n) for b in range(width)] for a in range(width)]
    values, vecs = np.linalg.eigh(np.array(cov))
    values, vecs = values[::-1], vecs[:, ::-1]
    dev = [(i, [n * a - b for a, b in zip(x, s)]) for i, x in xs]
    white = [(i, np.array([d / n for d in each]) @ vecs[:, :16] / np.sqrt(np.maximum(values[:16], 1e-300))) for i, each in dev]
    return n, [(i, sum(d * d for d in each)) for i, each in dev], white, values / values.sum()


@pytest.mark.parametrize("size", [1.0, 1e4, 1e16])
def test_whitening(spark, size):
    r = np.random.default_rng(3)
    base = (r.normal(size=(60, 20)) @ r.normal(size=(20, 20)) * size).tolist()
    rows = [*enumerate(base), (7, base[7]), (100, base[7]), (101, base[3][:18]), (102, None), (103, [1.0, None]), (104, [float("nan")] * 20), (105, [float("inf")] + base[0][1:]), (None, base[2]), (106, [])]
    got = whitening.whitened(vectors(spark, rows)).collect()
    n, deviations, white, explained = by_brute_force(rows)
    assert {x.n for x in got} == {n} and len(got) == 16 * len(deviations)
    mine = sorted((str(x.vec_id), str(x.deviation)) for x in got if x.component == 1)
    assert mine == sorted((str(i), str(d) if d < 10**38 else "None") for i, d in deviations)
    for k in range(16):
        mine = sorted((str(x.vec_id), x.whitened) for x in got if x.component == k + 1)
        theirs = sorted((str(i), w[k]) for i, w in white)
        sign = np.sign(sum(a * b for (_, a), (_, b) in zip(mine, theirs)))
        theirs = sorted((i, sign * w) for i, w in theirs)
        assert np.allclose([w for _, w in mine], [w for _, w in theirs], atol=1e-8)
        assert [x.explained for x in got if x.component == k + 1] == pytest.approx([explained[k]] * len(mine), rel=1e-7)
    assert len({x.identity_error for x in got}) == 1 and 0 <= got[0].identity_error < 1e-9


def test_whitening_of_little(spark):
    same = vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])
    assert whitening.whitened(same).count() == 0  # no variance, no component
    assert whitening.whitened(vectors(spark, [])).count() == 0
    flat = whitening.whitened(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).collect()
    assert {x.component for x in flat} == {1} and len(flat) == 9 and flat[0].explained == pytest.approx(1)
    assert sum(x.whitened for x in flat) == pytest.approx(0) and sum(x.whitened**2 for x in flat) == pytest.approx(9)


def test_limbs_and_digits():
    for y in (np.array([[-(2**63), 2**63 - 1, -1, 0, 2**20, -(2**20)]]), np.zeros((0, 3), dtype=np.int64)):
        parts = whitening.limbs(y)
        assert (sum(p.astype(np.int64).astype(object) * 2 ** (whitening.LIMB * k) for k, p in enumerate(parts)) == y).all()
    for whole_number in (0, -1, 2**100 + 17, -(2**150) + 3):
        assert sum(d << (32 * k) for k, d in enumerate(whitening.digits(whole_number))) == whole_number


def test_scatter_of_any_blocks_is_exact(monkeypatch):
    monkeypatch.setattr(whitening, "EXACT", 3)
    r = random.Random(2)
    rows = np.array([[r.randint(-(2 ** r.randint(1, 62)), 2 ** r.randint(1, 62)) for _ in range(4)] for _ in range(20)])
    held = whitening.Scatter()
    held.add(rows[:5, :2])
    held.add(rows[5:])
    padded = [[*map(int, x[:2]), 0, 0] if k < 5 else [*map(int, x)] for k, x in enumerate(rows)]
    assert held.n == 20 and held.sums.tolist() == [sum(c) for c in zip(*padded)]
    assert held.products.tolist() == [[sum(x[a] * x[b] for x in padded) for b in range(4)] for a in range(4)]


def test_whitening_of_the_table(spark):
    """The query itself, by fractions' integers on a small table."""
    got = queries.op11_whitening(spark, DATA)
    held = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    xs = {r.vec_id: [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding] for r in held}
    fit = np.array(sorted({tuple(x) for x in xs.values()}), dtype=object)
    n, s = len(fit), fit.sum(0)
    want = {i: int(((n * np.array(x, dtype=object) - s) ** 2).sum()) for i, x in xs.items()}
    rows = got.collect()
    assert {(r.vec_id, r.n, r.deviation) for r in rows} == {(i, n, d) for i, d in want.items()}
    assert len(rows) == 16 * len(held) and rows[0].identity_error < 1e-9
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}


def texts():
    r = random.Random(5)
    letters = " ab'▁sS .,\n\t0é½²́ İΣ!<|>中\x1c\x85​👩\x00ﬁ"
    odd = ["", " ", "  ", " \n\t ", "▁", "▁▁x ", "<s>hi</s><unk><0x41>", "日本語👩‍👩‍👧", "x" * 30000, " " * 5000, "中é" * 9000, "word " * 2000]
    return odd + ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(500)]


def test_piece_bpe_is_the_librarys(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i, t, *"abcdefg") for i, t in enumerate(texts())]
    rows = [(*r[:4], 5, *r[5:]) for r in rows]
    rows += [rows[3], (900, None, *[None] * 7), (None, "no id", *[None] * 7)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = []
    for r in rows:
        ids = lib.encode(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    for check in (piece_bpe.RUNS, piece_bpe.TEXTS, ""):
        assert sorted(map(repr, map(tuple, piece_bpe.round_trip(docs, MODEL, check).collect()))) == sorted(map(repr, want))
    back = {r.doc_id: r.text for r in piece_bpe.decoded(piece_bpe.encoded(docs, MODEL), MODEL).collect()}
    assert all(back[i] == lib.decode(lib.encode(t)) for i, t in enumerate(texts()))
    assert piece_bpe.round_trip(docs.limit(0), MODEL).count() == 0


def test_any_ids_are_read_as_by_the_library(spark):
    held, r = piece_bpe.pieces(MODEL), random.Random(1)
    some = [0, 1, 2, 259, 260, *range(3, 259)]
    for _ in range(3000):
        ids = [r.choice(some + [r.randrange(32000)] * 60) for _ in range(r.randint(0, 12))]
        assert held.decode(ids) == held.library.decode(ids)
    rows = spark.createDataFrame([(1, None), (2, []), (3, [464, 1])], "doc_id long, ids array<int>")
    assert {x.doc_id: x.text for x in piece_bpe.decoded(rows, MODEL).collect()}[1] == ""
    for ids in ([-1], [10**6]):
        with pytest.raises(Exception, match="IndexError|no piece|out of range"):
            held.decode(ids)


@pytest.mark.parametrize("agenda", ["by_list", "by_heap"])
def test_agenda_order(agenda):
    """Highest score first, of equal ones the leftmost; a pair that is gone is passed over."""
    held = piece_bpe.Pieces(MODEL)
    merged = getattr(held, agenda)
    held.ranks = {"ab": 2, "bc": 1, "aa": 5, "aaa": 5}
    assert merged("abc") == ["a", "bc"] and merged("aaaaa") == ["aaa", "aa"] and merged("x") == ["x"]
    held.ranks["abc"] = 9
    assert merged("abcab") == ["abc", "ab"]


def test_both_agendas_are_one():
    held, r = piece_bpe.pieces(MODEL), random.Random(3)
    for _ in range(3000):
        run = "".join(r.choice("▁▁▁aeinrst.,é中") for _ in range(r.randint(1, 40)))
        assert held.by_list(run) == held.by_heap(run)


def test_a_difference_from_the_library_is_an_error():
    held = piece_bpe.Pieces(MODEL)
    held.ranks.pop("▁the")
    for check in (piece_bpe.RUNS, piece_bpe.TEXTS):
        held.known.clear()
        with pytest.raises(ValueError, match="other ids"):
            piece_bpe._encoded(held, ["the end"], check)
    with pytest.raises(ValueError, match="read otherwise"):
        held.read[1000] = "x"
        piece_bpe._decoded(held, [[1000]], piece_bpe.RUNS)


def audit_rows():
    r = random.Random(4)
    words = ["w%d" % k for k in range(300)]
    made = []
    for i in range(120):
        n = r.choice([0, 1, 50, 199, 200, 201, 400])
        text = " ".join(r.choice(words[: r.choice([5, 300])]) for _ in range(n))
        text += r.choice(["", " A|B", " 100% #x", " ABCDEFGH" * r.choice([1, 40]), "É" * 30])
        made.append((i, text, r.choice(["en", "fr", None, ""])))
    copies = [(200 + i, made[i % 7][1], r.choice(["en", "fr"])) for i in range(60)]
    odd = [made[0], made[0], (0, made[1][1], "en"), (None, made[0][1], "en"), (None, made[0][1], "en"), (None, None, None), (500, None, "de"), (501, "", "de"), (502, "ab " * 30000, "de")]
    return made + copies + odd


def audit_by_brute_force(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and smallest[t] < i}
        docs.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out, shapley = [], defaultdict(int)
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            held = mine
            for step, f in enumerate(order, 1):
                gone, held = [d for d in held if f in d[1]], [d for d in held if f not in d[1]]
                shapley[part, f] += len(gone)
                alone = sum(d[1] == {f} for d in mine)
                out.append([part, order, step, len(held), len(gone), sum(f in d[1] for d in mine) - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)])
    return sorted((*x, shapley[x[0], x[1][x[2] - 1]]) for x in out)


def test_filter_audit(spark, monkeypatch):
    rows = audit_rows()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 260, 2)] + [(4, 1, 0), (4, None, None), (None, 1, 1), (9, 1, 1), (9, 1, 1), (5, None, 1)]
    docs = spark.createDataFrame([(i, t, lang, "s", 1, "p", "d", "m", "k") for i, t, lang in rows], DOCS).repartition(5)
    held = spark.createDataFrame([(*x, "k") for x in labels], LABELS)
    want = audit_by_brute_force(rows, labels)
    assert sorted(map(tuple, filter_audit.audited(docs, held).collect())) == want
    monkeypatch.setattr(filter_audit, "PARTS", 2)  # arrays handed on in between
    assert sorted(map(tuple, filter_audit.audited(docs, held).collect())) == want
    assert filter_audit.audited(docs.limit(0), held).count() == 0
    assert {r.good_lost + r.toxic_lost for r in filter_audit.audited(docs, held.limit(0)).collect()} == {0}


def test_filter_audit_is_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()["op13_filter_audit"])
    names = [x[0] for x in want.description]
    got = queries.op13_filter_audit(spark, DATA)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())
    assert set(got.columns) == set(names)


def test_prefixes_and_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    from floeframe.llm import personal

    monkeypatch.setattr(personal, "BLOCK", 3)
    monkeypatch.setattr(personal, "PIECE", 4)
    r = random.Random(1)
    rows = [([r.randint(-5, 9) for _ in range(n)], "aé👩\n中"[: n % 6] * 3) for n in range(12)]
    df = spark.createDataFrame(rows, "v array<int>, t string")
    made = df.select("v", "t", personal.prefixes(F.col("v"), F.lit(0), lambda a, b: a + b).alias("p"), personal.in_pieces(F.col("t")).alias("c")).collect()
    assert [x.p for x in made] == [[sum(v[:i]) for i in range(len(v))] for v, _ in rows]
    cuts = [(a, b) for a in range(16) for b in range(a, 16)]
    got = spark.createDataFrame([(t, a, b) for _, t in rows for a, b in cuts if b <= len(t)], "t string, a int, b int")
    assert all(x.s == x.t[x.a : x.b] for x in got.select("*", personal.between(personal.in_pieces(F.col("t")), F.col("a"), F.col("b")).alias("s")).collect())


def test_disclosing_terms_wherever_they_stand(spark):
    """Far from entities, in texts without one, in odd case, after long texts; not within an entity."""
    import re

    from floeframe.llm import personal

    r = random.Random(8)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(n))
    texts = [f"{prose(40)} ward contact user{i}@mail.example.com {prose(40)} 👩 Contact, {prose(300)}\n\n CONTACT" for i in range(12)]
    texts += ["Contact 日本 contacts contact", "", "contact@b.org (contact) x@contact.com 9.8.7.6contact contact", "xcontact éCONTACT contact_me"]
    texts += [prose(400) for _ in range(90)] + [f"contact u{i}@b.org" for i in range(40)]
    df = spark.createDataFrame([*enumerate(texts), (900, None)], "doc_id long, text string")
    told = {x.term for x in personal.disclosing(df, personal.found(df)).collect()}
    assert "contact" in told
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    got = {x.doc_id: x for x in personal.with_terms(df).collect()}
    assert len(got) == len(texts) + 1 and got[900].term == []
    for i, t in enumerate(texts):
        taken = [(s.start, s.end) for kind in personal.PATTERNS for s in got[i][kind]]
        want = [(*m.span(), m[0].lower()) for m in term.finditer(t) if m[0].lower() in told]
        want = [x for x in want if all(x[1] <= a or x[0] >= b for a, b in taken)]
        assert [tuple(s) for s in got[i].term] == want, t
    assert all(sum(s.found == "contact" for s in got[i].term) == 3 for i in range(12))
    assert sum(s.found == "contact" for s in got[12].term) == 2 and sum(s.found == "contact" for s in got[14].term) == 2
    out = {x.doc_id: x.text or "" for x in personal.sanitised(df).collect()}
    assert not any("@" in t for t in out.values()) and out[14].startswith("[EMAIL] ([TERM]) [EMAIL] ")


def test_many_addresses_in_one_text(spark):
    import time

    from floeframe.llm import personal

    def took(n):
        df = spark.createDataFrame([(1, " ".join(f"write to a{k}@b{k % 7}.org or" for k in range(n)), n)], "doc_id long, text string, n_chars long")
        began = time.time()
        (r,) = personal.sanitised(df).collect()
        assert r.text.count("[EMAIL]") == n and "@" not in r.text and r.n_chars == len(r.text)
        return time.time() - began

    took(10)
    fixed = took(10)
    assert took(20_000) < fixed + 10


def test_one_of_each_whatever_the_order(spark):
    from floeframe.llm import near_copies

    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, f"{words} {k}", "en", k) for k in range(9)] + [(2, "other words stand here at last", "fr", 5), (None, words, "de", 1)]
    picked = set()
    for k in range(3):
        random.Random(k).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int").repartition(k + 1)
        got = near_copies.one_of_each(df).collect()
        assert sorted(str(r.doc_id) for r in got) == ["1", "2", "None"]
        picked.add(tuple(sorted(map(repr, got))))
    assert len(picked) == 1


def test_comments_go_and_names_do_not_outdo_the_article():
    from floeframe.llm import html_text

    body, more = "<p>one two three four</p><p>five six</p>", "<p>what a fine text this is</p>"
    text = "one two three four\n\nfive six"
    long = " ".join(f"word{k}" for k in range(60))
    for page, want in (
        (f"<article>{body}</article><section class='reader-comments'>{more}</section>", text),
        (f"<main><article>{body}</article><div id='post-comments-list'><article class='comment-body'>{more * 9}</article></div></main>", text),
        (f"<article class='post notice'>{body}</article>", text),
        (f"<main role='alert'>{body}</main>", text),
        (f"<div class='search-container'><article>{body}</article></div>", text),
        (f"<body><form id='aspnetForm'><article>{body}</article></form>", text),
        (f"<body><form id='aspnetForm'><nav>a b</nav><p>{long}</p></form></body>", long),
        (f"<form><label>name</label></form><article>{body}</article><aside class='related'><article>a b</article></aside>", text),
        (f"<nav>{long}</nav><article>{body}</article>", text),
        (f"<article class='no-comments'>{body}</article>", text),
    ):
        assert html_text.main_text(page, {}) == want, page


def test_word_order_counts_in_the_score(spark):
    from floeframe.llm import linear

    r = random.Random(6)
    good = [" ".join(f"a{(k + j) % 30}" for j in range(60)) for k in range(60)]  # the same words in order
    bad = [" ".join(r.sample(x.split(), 60)) for x in good]
    rows = [(t, float(q)) for q, some in ((1, good), (0, bad)) for t in some]
    found = linear.examples(spark.createDataFrame(rows, "text string, target double"), ngrams=True)
    judged = linear.scorer(linear.fitted(found, ngrams=True))
    new = [f"a{(7 + j) % 30}" for j in range(90)]
    assert judged(new) > 0.9 > 0.1 > judged(r.sample(new, 90))
    plain = linear.scorer(linear.fitted(linear.examples(spark.createDataFrame(rows, "text string, target double"))))
    assert abs(plain(new) - plain(r.sample(new, 90))) < 0.2  # words alone can't tell


def test_scores_are_the_features_scores():
    """The scorer's cache and numbers give what the features give."""
    from floeframe.llm import linear

    r = np.random.default_rng(2)
    for ngrams in (False, True):
        model = r.normal(size=linear.ALL + linear.NGRAMS * ngrams), 0.1
        judged = linear.scorer(model)
        for n in (0, 1, 2, 3, 50):
            words = [f"w{k}é" for k in r.integers(0, 9, n)]
            index, value = linear.text_features(words, linear.Buckets(), ngrams)
            want = 0.1 + float((model[0][index] * value).sum())
            assert judged(words) == pytest.approx(1 / (1 + np.exp(-want)), rel=1e-4)
