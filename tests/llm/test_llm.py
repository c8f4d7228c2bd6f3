"""The training-data operators against brute force, on fixtures with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floeframe.llm import byte_bpe, components, html_text, licenses, linear, near_copies, packing, personal, quality_rules, token_store, tokenize, top_k, weak_labels, words

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, row int, kind string"


def prose(r, n, vocabulary=400):
    return " ".join(f"w{r.randint(0, vocabulary)}" for _ in range(n)) + "."


def texts():
    r = random.Random(5)
    base = prose(r, 300)
    near = base.replace(" w1", " changed ", 2)
    odd = ["", " \n\t ", "one", "one two three four", "a\x1cb  c\t\td  e\n\n", "É é ΣΑΣ İ 日本語 👩‍👩‍👧 <|endoftext|> it's IT'S", "x" * 30000, prose(r, 20000, 30), "word " * 200, "one <|endoftext|> two<|startoftext|>x <|ENDOFTEXT|> <|endoftext", "Licensed under CC BY-NC 4.0. All Rights Reserved all rights reserved"]
    odd += ["mail a@b.cc_d@e.f or x@@y.z 1.2.3.4.5.6.7.8 256.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112 +1 (988) 555-2485 +12", "5" * 400 + " " + "1 2 3 " * 3000]
    return [base, base, near, base + " tail", *odd, *(prose(r, r.randint(1, 200)) for _ in range(20))]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t), "x", 1, "k") for i, t in enumerate(texts())]
    rows += [rows[0], (100, None, None, None, None, None, None, None), (None, "no id here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_byte_bpe(docs, empty):
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in rows_of(docs):
        ids = plain.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    same(map(tuple, byte_bpe.round_trip(docs, BYTES, public_tokenizers.PATTERN).collect()), want)
    assert byte_bpe.round_trip(empty, BYTES, public_tokenizers.PATTERN).count() == 0


def test_offsets_and_split_characters(spark):
    df = spark.createDataFrame([(1, "a 👩 b日ק")], "doc_id long, text string")
    (r,) = byte_bpe.encoded(df, BYTES, public_tokenizers.PATTERN, offsets=True).collect()
    assert r.offsets[0] == 0 and r.offsets == sorted(r.offsets) and len(r.ids) == len(r.offsets)
    half = spark.createDataFrame([(1, r.ids), (2, r.ids[:2]), (3, None)], "doc_id long, ids array<int>")
    got = {x.doc_id: x.text for x in byte_bpe.decoded(half, BYTES).collect()}
    assert got[1] == "a 👩 b日ק" and got[2].startswith("a ") and got[2].endswith("�") and got[3] == ""


def test_word_ids_are_the_librarys():
    r, plain, encode = random.Random(1), Tokenizer.from_file(WORDS), tokenize.word_encoder(WORDS)
    letters = "ab'sS .,\n\t0é½²́ İΣ!<|>中\x1c\x85"
    for t in texts()[4:12] + ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(2000)]:
        assert encode(t) == tokenize.packed(plain.encode(t, add_special_tokens=False).ids), t[:80]


def test_token_store(spark, docs, empty, tmp_path):
    token_store.write(docs, str(tmp_path / "a"), WORDS)
    plain, at, want, ids_of = Tokenizer.from_file(WORDS), 0, [], {}
    for i, t in sorted(rows_of(docs), key=lambda x: (x[0] is not None, x[0])):
        ids = plain.encode(t, add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(tokenize.packed(ids))))
        ids_of[at], at = ids, at + len(ids)
    same(map(tuple, token_store.checks(spark, str(tmp_path / "a")).collect()), want)
    assert {r.start: r.ids for r in token_store.documents(spark, str(tmp_path / "a")).collect()} == ids_of
    stored = spark.read.schema(token_store.ROWS).parquet(str(tmp_path / "a/cut")).where("kind = 'chunk'")
    assert stored.count() == stored.select("digests").distinct().count()
    token_store.write(empty, str(tmp_path / "b"), WORDS)
    assert token_store.checks(spark, str(tmp_path / "b")).count() == 0


def test_token_store_notices_damage(spark, docs, tmp_path):
    token_store.write(docs.where("doc_id < 3"), str(tmp_path / "a"), WORDS)
    spark.read.parquet(str(tmp_path / "a/recipes")).withColumn("n_tokens", F.col("n_tokens") + 1).write.parquet(str(tmp_path / "other"))
    import shutil

    shutil.rmtree(tmp_path / "a/recipes")
    shutil.move(tmp_path / "other", tmp_path / "a/recipes")
    with pytest.raises(ValueError, match="root"):
        token_store.checks(spark, str(tmp_path / "a"))


@pytest.mark.parametrize("n", [1, 5, 7, 8, 9, 20000])
def test_cuts_cover(n):
    ids = np.random.default_rng(n).integers(0, 50, n).astype("<u4")
    ends = token_store.cuts(ids)
    assert ends[-1] == n and all(0 < b - a <= token_store.LONGEST for a, b in zip([0, *ends], ends))


def test_packing(docs, empty):
    got = packing.packed_sequences(docs, WORDS, capacity=256).collect()
    plain, want = Tokenizer.from_file(WORDS), []
    for i, t in rows_of(docs):
        ids = plain.encode(t, add_special_tokens=False).ids + [1]
        want += [(i, k, a, len(ids[a : a + 256]), zlib.crc32(tokenize.packed(ids[a : a + 256]))) for k, a in enumerate(range(0, len(ids), 256))]
    same([tuple(r)[:5] for r in got], want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= -(-sum(r.length for r in got) // 256) + 2
    assert packing.packed_sequences(empty, WORDS).count() == 0


def test_search_empties_bins():
    lengths = [6, 6, 4, 4, 3, 3, 2, 2, 5, 5]
    bins = packing.Search([[0], [1], [2, 4], [3, 5], [6, 7], [8, 9]], lengths, 10).run(4)
    assert len(bins) == 4 and sorted(i for b in bins for i in b) == list(range(10)) and all(sum(lengths[i] for i in b) <= 10 for b in bins)


def fewest_by_trying(lengths, capacity):
    """The least number of bins, all ways tried."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] >= lengths[k] and bins[b] not in bins[:b]:
                place(k + 1, [*bins[:b], bins[b] - lengths[k], *bins[b + 1 :]])
        place(k + 1, [*bins, capacity - lengths[k]])

    place(0, [])
    return best


def test_search_is_close_to_the_fewest_bins():
    r, over = random.Random(4), 0
    for _ in range(60):
        lengths = [r.randint(1, r.choice((20, 60, 99))) for _ in range(r.randint(1, 10))]
        got, want = packing.packed_bins(lengths, 100), fewest_by_trying(lengths, 100)
        assert packing.fewest(lengths, 100) <= want <= len(got) and sorted(i for b in got for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in got)
        over += len(got) - want
    assert over <= 1
    for n, most in ((300, 99), (300, 45), (2000, 30), (400, 60)):
        lengths = [r.randint(1, most) for _ in range(n)]
        longest = sorted(range(n), key=lambda i: -lengths[i])
        assert packing.fewest(lengths, 100) <= len(packing.packed_bins(lengths, 100)) <= len(packing.best_fit(lengths, 100, longest))
    assert packing.packed_bins([], 100) == [] and packing.packed_bins([50] * 6 + [1], 100)


def brute_classes(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(i, len(sets[i]), root(i)) for i, _ in rows]


def test_near_copies(docs, empty):
    same(map(tuple, near_copies.classes(docs).collect()), brute_classes(rows_of(docs)))
    assert near_copies.classes(empty).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 12, 60, 140, 700])
def test_near_copies_at_the_threshold(spark, n):
    """Families of edits around 0.8, in chains, and a passage that all share."""
    r = random.Random(n)
    rows, passage = [], [f"p{k}" for k in range(20)]
    for f in range(4):
        text = [f"f{f}x{k}" for k in range(n)] + passage * (n >= 60)
        for k in range(9):
            rows.append((len(rows), " ".join(text)))
            for _ in range(max(1, n // r.choice((25, 40, 60)))):
                text[r.randrange(len(text))] = f"e{r.random()}"
            if k % 4 == 3:
                text = text[: max(1, int(len(text) * 0.85))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(map(tuple, near_copies.classes(df).collect()), brute_classes(rows))


def test_tree_search_equals_all_pairs():
    import pandas as pd

    g = np.random.default_rng(0)
    base = g.integers(0, 40, (12, near_copies.DIMENSIONS))
    points = [np.maximum(b + g.integers(-1, 2, b.shape), 0) for b in base for _ in range(20)]
    frame = pd.DataFrame({"partition": 7, "n": [int(p.sum()) for p in points], "component": range(len(points)), "counts": [p.astype("uint8").tobytes() for p in points], "firsts": [[7]] * len(points)})
    a, b = near_copies.index_pairs(frame)
    want = {(i, j) for i in range(240) for j in range(i) if 9 * np.minimum(points[i], points[j]).sum() >= 4 * (points[i].sum() + points[j].sum())}
    assert {(max(x, y), min(x, y)) for x, y in zip(a.tolist(), b.tolist())} == want and len(a) == len(want)


def test_partitions_of_repeated_rows_are_told_apart(spark):
    """Rows repeated in two tasks: {1, 2, 3, 6} and {1, 4, 5, 6} have different pairs, and both are searched."""
    point = lambda k: bytes(10 if i == k else 0 for i in range(near_copies.DIMENSIONS))
    points = spark.createDataFrame([(i, i, i, 10, point(k)) for i, k in ((1, 0), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3))], "key long, doc_id long, print long, n long, counts binary")
    met = spark.createDataFrame([(p, i, i, 1, 1) for p, ids in ((70, (1, 2, 3, 6)), (80, (1, 4, 5, 6))) for i in ids], "partition long, key long, doc_id long, lead long, lead_id long")
    keep = near_copies.Scratch(spark, "test")
    labels = spark.createDataFrame([], "node long, component long")
    got = near_copies.open_pairs(met.unionByName(met), labels, points, keep)
    assert {tuple(x) for x in got.collect()} == {(3, 2), (5, 4)}
    keep.drop()


def test_every_text_of_an_id_and_rows_without_one(spark):
    """In one task: an unnamed row before a named one of the same text, and ids of several unlike texts."""
    r = random.Random(9)
    rows = []
    for i in range(0, 60, 3):
        text = prose(r, 200, 4000)
        rows += [(None, text), (i, text), (i + 1, text + " one more")]
        rows += [(1000 + i, prose(r, n, 4000)) for n in (30, 200, 900)]
        short, long = prose(r, 30, 4000), prose(r, 1200, 4000)
        rows += [(2000 + i, short), (2000 + i, long), (2001 + i, short + " x"), (2002 + i, long + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {x.doc_id: x.component_id for x in near_copies.classes(df).collect() if x.doc_id is not None}
    for i in range(0, 60, 3):
        assert got[i + 1] == i and got[1000 + i] == 1000 + i
        assert got[2001 + i] == got[2002 + i] == got[2000 + i] == 2000 + i


def test_one_of_each(docs):
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns
    component = {i: c for i, _, c in brute_classes(rows_of(docs))}
    same([r.doc_id for r in kept.collect()], [*(i for i in component if i is not None and component[i] == i), None])


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (200, 201), (5, 5), (300, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(1, 41), 100], 1), **dict.fromkeys([200, 201, 300], 200)}


def brute_top_k(rows):
    v = {i: [int(np.floor(64 * c)) for c in x] for i, x in rows}
    want = []
    for q in v:
        if q % 20 == 0:
            score = lambda p: max(-int(top_k.LONG), min(int(top_k.LONG), sum(a * b for a, b in zip(v[q], v[p]))))  # noqa: B023, E731
            best = sorted((-score(p), p) for p in v if p != q)[:20]
            want += [(q, k + 1, p, -s) for k, (s, p) in enumerate(best)]
    return want


def test_top_k(spark):
    g = np.random.default_rng(3)
    base = g.normal(size=(300, 8)).round(2)
    rows = [(i, [float(x) for x in (base[7] if i % 3 == 0 else v)]) for i, v in enumerate(base)]
    bad = [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (1080, []), (rows[4][0], rows[4][1]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    same(map(tuple, top_k.top_k(df).collect()), brute_top_k(rows))
    assert top_k.top_k(df.limit(0)).count() == 0
    assert top_k.top_k(df.where("vec_id IN (20, 21)")).count() == 1
    extra = df.select("*", F.lit("x").alias("query"), F.lit(1).alias("cid"), F.lit(2).alias("v"))
    assert top_k.top_k(extra.where("vec_id < 50")).count() == 3 * 20


@pytest.mark.parametrize("size", [70_000.0, 3e8, 1e30])
def test_top_k_of_large_components_is_exact(spark, size):
    g = np.random.default_rng(5)
    rows = [(i, [float(x) * (size if i % 7 == 0 else 1) for x in v]) for i, v in enumerate(g.normal(size=(120, 6)).round(3))]
    if size == 1e30:  # beyond a long: all of these count as the same
        rows = [(i, [min(max(c, -top_k.LONG / 64), top_k.LONG / 64) for c in x]) for i, x in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    same(map(tuple, top_k.top_k(df).collect()), brute_top_k(rows))


def test_dual_tree_prunes_and_equals_brute_force(monkeypatch):
    import pandas as pd

    g, seen = np.random.default_rng(6), []
    points = np.concatenate([g.integers(-9, 10, (200, 5)) + 60 * g.integers(-3, 4, 5) for _ in range(20)]).astype(float)
    data = pd.DataFrame({"cid": range(len(points)), "v": list(points)})
    queries = data.iloc[::20].assign(bound=-np.inf)
    exact = top_k.exact

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(self.shape[0] * other.shape[1])
            return np.asarray(self) @ np.asarray(other)

    monkeypatch.setattr(top_k, "exact", lambda q, p: (exact(q, p)[0].view(Counted), exact(q, p)[1]))
    got = top_k.searched(queries, data, 5)
    want = []
    for i in queries["cid"]:
        scores = points @ points[i]
        want += [(i, j, int(scores[j])) for j in sorted(range(len(points)), key=lambda j: (-scores[j], j))[:5]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
    assert sum(seen) < len(queries) * len(points) / 3


def test_quality_rules(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(30)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    want = []
    for i, t in rows_of(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + d for k, x in enumerate(tri) for d in range(3) if tri.count(x) > 1} if len(w) < 3000 else None
        lines, seen, dup = t.split("\n"), set(), 0
        for line in lines:
            dup += line in seen and re.search(r"[^\x20\x09-\x0D]", line) is not None
            seen.add(line)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, covered and len(covered) or (0 if covered is not None else None)))
    got = quality_rules.rules(docs, labels).collect()
    exact = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) for r in got}
    assert exact == {x[:5] for x in want}
    repeats = {x[0]: x[5] for x in want if x[5] is not None}
    assert all(r.n_repeat_words == repeats[r.doc_id] for r in got if r.doc_id in repeats)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.rules(empty, labels).count() == 0
    assert quality_rules.rules(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality_rules.passed(docs, labels.limit(0)).columns == docs.columns


def test_long_repetition():
    w = words.words_of(prose(random.Random(2), 20000, 30))
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    from collections import Counter

    twice = {x for x, n in Counter(tri).items() if n > 1}
    assert words.repeated_words(w) == len({k + d for k, x in enumerate(tri) if x in twice for d in range(3)})


def test_held_out_accuracy(spark):
    """Trained on half of the labelled rows, right on the other half; weak labels see no label at all."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    good = quality_rules.rules(docs, seen).join(held, "doc_id").agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("double"))).first()[0]
    weak = weak_labels.classified(docs).join(labels, "doc_id")
    assert good >= 0.97
    assert weak.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0] >= 0.97
    assert weak.where("quality = 1 AND NOT kept").count() == 0


def test_weak_labels_edges(docs, empty):
    got = weak_labels.classified(docs)
    assert got.count() == docs.count() and got.where("score IS NULL").count() == 0
    assert weak_labels.classified(empty).count() == 0 and weak_labels.passed(empty).columns == empty.columns


def test_expectation_maximisation_finds_the_bad_labeller():
    r = random.Random(9)
    votes = []
    for _ in range(3000):
        good = r.random() < 0.7
        flip = lambda p: "01"[good if r.random() < p else not good]  # noqa: B023, E731
        votes.append(flip(0.95) + flip(0.9) + flip(0.85) + flip(0.5))
    from collections import Counter

    _, table, share = weak_labels.estimated(list(Counter(votes).items()))
    assert abs(share - 0.7) < 0.05 and table[0, 1, 1] > 0.9 and abs(table[3, 1, 1] - 0.5) < 0.1


def test_personal_data(docs, empty):
    rx = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            twice = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(d))]
            return 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    want = []
    for i, t in rows_of(docs):
        found = {k: [m.span() for m in re.finditer(p, t) if ok(k, m.group())] for k, p in rx.items()}
        joined = ",".join(f"{k}:{a}:{b}" for k in rx for a, b in found[k])
        want.append((i, *(len(found[k]) for k in rx), hashlib.sha256(joined.encode()).hexdigest()))
    got = personal.personal_data(docs).collect()
    same([tuple(r)[:6] for r in got], want)
    assert sum(x[1] + x[2] + x[3] + x[4] for x in want) >= 6
    assert personal.personal_data(empty).count() == 0


def test_disclosing_terms_and_sanitising(spark):
    r = random.Random(4)
    rows = [(i, f"{prose(r, 10)} write to patient{i}x contact user{i}@mail.example.com today {prose(r, 10)}", i) for i in range(12)]
    rows += [(100 + i, prose(r, 400), i) for i in range(20)] + [(50, None, 3), (51, "nothing here", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, email int")
    assert "contact" in {x.term for x in personal.disclosing(df, personal.found(df)).collect()}
    out = {x.doc_id: x for x in personal.sanitised(df).collect()}
    assert all("[TERM] [EMAIL]" in out[i].text and "@" not in out[i].text for i in range(12))
    assert out[50].text is None and out[51].text == "nothing here" and out[51].email == 4 and len(out) == 34


def test_disclosure_by_brute_force(spark):
    """Two words on either side of a mail address, any separators, texts that begin or end there."""
    import math

    r = random.Random(12)
    texts = [f"patient user{i}@mail.example.com" for i in range(12)] + [f"my ward:      user{i}@mail.example.com" for i in range(9)]
    texts += [f"{prose(r, 30)} clinic, visit <a{i % 4}@b.org> soon {prose(r, 20)}" for i in range(16)] + [prose(r, 500) for _ in range(12)] + ["visit a clinic", "", "x@y.zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    term = re.compile(r"[A-Za-z0-9]+")
    near, values, total, n_near = {}, {}, {}, 0
    for t in texts:
        words_ = [(x[0].lower(), *x.span()) for x in term.finditer(t)]
        for w, _, _ in words_:
            total[w] = total.get(w, 0) + 1
        for m in re.finditer(personal.PATTERNS["email"].replace(r"|\G", ""), t):
            for w, _, _ in [x for x in words_ if x[2] < m.start()][-2:] + [x for x in words_ if x[1] > m.end()][:2]:
                near[w] = near.get(w, 0) + 1
                values.setdefault(w, set()).add(m[0])
                n_near += 1
    want = set()
    for w, n in near.items():
        bits = math.log2(n / total[w] * sum(total.values()) / n_near)
        if len(values[w]) >= personal.LEAST_VALUES and n >= personal.SHARE * total[w] and bits >= personal.BITS:
            want.add((w, n, total[w]))
    got = {(x.term, x.near, x.total) for x in personal.disclosing(df, personal.found(df)).collect()}
    assert got == want and {"patient", "ward", "my"} <= {w for w, _, _ in want}


def test_neighbours_are_whole_words_at_any_distance(spark):
    word, gap = "w" * 300, " " * 200
    texts = ["Email: a@b.org", "contact:      a@b.org", "see list\n\n    *  a@b.org\n\n      - x", f"{word} é {word} a@b.org {word} {word} z", f"one two{gap}a@b.org{gap}three four", "a@b.org", "q x9.8.7.6y r s t", "日本 𝒳y a@b.org 👩 c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.near or [] for x in personal.found(df).collect()}
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    for i, t in enumerate(texts):
        m = re.search(r"a@b\.org|9\.8\.7\.6", t)
        places = [(x[0].lower(), *x.span()) for x in term.finditer(t)]
        want = [x for x in places if x[2] <= m.start() and t[x[2]] != m[0][0]][-2:] + [x for x in places if x[1] > m.end()][:2]
        assert sorted(tuple(x)[:3] for x in got[i]) == sorted(want), t


def test_licenses(docs, empty):
    sep = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = []
    for i, t in rows_of(docs):
        w = sep.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        places, found = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            hits = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += hits
            found |= {label} if hits else set()
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))))
    got = licenses.scanned(docs).collect()
    same([tuple(r)[:6] for r in got], want)
    assert {r.labels for r in got} == {"", "cc-by,cc-by-nc-4.0,reserved"}
    assert licenses.scanned(empty).count() == 0


def test_diagonals_allow_edits(spark):
    text = "noise permission is hereby granted free of any charge to any person obtaining a copy of this software and associated documentation files noise"
    df = spark.createDataFrame([(1, text), (2, "granted free of charge")], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scanned(df).collect()} == {1: "mit", 2: ""}


def test_notices_and_mentions(spark):
    """Each template has its own label alone, short mentions are found, and what only sounds like one is not."""
    own = [(i, label, t) for i, (label, t) in enumerate(licenses.TEMPLATES)]
    said = [
        ("mit", "This code is released under the terms of the MIT License."),
        ("mit", "distributed under the MIT license, see the file"),
        ("apache-2.0", "subject to the terms of the Apache License"),
        ("gpl,lgpl", "under the terms of the GNU Lesser General Public License"),
        ("agpl-3.0,gpl", "see the GNU Affero General Public License for details"),
        ("mpl-2.0", "under the terms of the Mozilla Public License"),
        ("", "released under the terms of the agreement, and the license of the driver"),
        ("", "the software is provided without a manual; permission is granted by the author"),
    ]
    rows = own + [(1000 + i, label, t) for i, (label, t) in enumerate(said)]
    df = spark.createDataFrame(rows, "doc_id long, want string, text string")
    got = {r.doc_id: r.labels for r in licenses.scanned(df).collect()}
    for i, label, text in rows:
        if i < 1000:
            assert set(got[i].split(",")) - {"gpl", "cc-by"} == {label}, text
        else:
            assert got[i] == label, text


def test_diagonals_by_brute_force(spark):
    """Templates with words dropped, put in, swapped and cut, against the same rules in plain Python."""
    r, rows = random.Random(8), []
    for i in range(240):
        w = r.choice(licenses.TEMPLATES)[1].split()
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(w))
            what = r.random()
            if what < 0.35:
                w = w[:k] + w[k + 1 :] or ["x"]
            elif what < 0.7:
                w = w[:k] + ["new"] * r.randint(1, 3) + w[k:]
            else:
                j = r.randrange(len(w))
                w[k], w[j] = w[j], w[k]
        rows.append((i, " ".join(["noise"] * r.randint(0, 3) + w + w[: r.randint(0, 6)])))
    rows += [(500, "under the mit the mit license"), (501, "license mit the under released"), (502, "released under the mit license")]

    def brute(text):
        w, found = text.split(), set()
        for label, template in licenses.TEMPLATES:
            t, g = template.split(), licenses.GRAM
            hits = sorted((p, a) for p in range(len(w) - g + 1) for a in range(len(t) - g + 1) if w[p : p + g] == t[a : a + g])
            diagonals, group = sorted({p - a for p, a in hits}), {}
            for k, d in enumerate(diagonals):
                group[d] = group[diagonals[k - 1]] if k and d - diagonals[k - 1] <= licenses.GAP else d
            for run in set(group.values()):
                own = [(p, a) for p, a in hits if group[p - a] == run]
                last, order = -1, []
                for p, a in own:
                    if a > last:
                        order.append(a)
                        last = a
                covered = len({a + k for a in order for k in range(g)})
                span = own[-1][0] + g - own[0][0]
                share, edits = len(order) / (len(t) - g + 1), len(t) - covered + max(span - covered, 0)
                if share >= licenses.COVERED and edits <= (1 - licenses.COVERED) * len(t) + 1e-9:
                    found.add((own[0][0], own[-1][0] + g - 1, label))
        return ",".join(f"{c}:{a}:{b}" for a, b, c in sorted(found))

    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.spans for x in licenses.scanned(df).collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert got[500] == got[501] == "" and got[502] == "mit:0:4" and sum(map(bool, got.values())) > 60


PAGE = """<body><header><a href=/>Home</a> Site</header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First para with <a href=x>a  link</a>&nbsp;here.<br>Next line<p>Second <b>bold</b>text &lt;tag&gt; goes on
for some words.</p><div class="ad">Buy this now</div><script>var t="</p>";</script><ul><li>an item of it</li></ul></article>
<form>Sign up</form><div id="comments"><p>I am a reader</p></div><footer>(c) 2020 Nobody</footer>"""


def test_html_text(spark):
    want = "Title & more\n\nFirst para with a link here. Next line\n\nSecond boldtext <tag> goes on for some words.\n\nan item of it"
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "only <b>words</b> here"), (None, "u", "<p>x" * 3000)], "page_id long, url string, html string")
    got = html_text.extracted(df).collect()
    assert sorted((r.page_id or 0, r.text[:200], r.n_chars) for r in got if r.page_id) == [(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0), (4, "only words here", 15)]
    assert html_text.extracted(df.limit(0)).count() == 0


def test_pages_article_is_the_text(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extracted(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inside))
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_no_page_is_swallowed_to_its_end():
    body, text = "<p>one two three four</p><p>five six</p>", "one two three four\n\nfive six"
    for page in (
        f"<html><head><title>t</title><meta x=1>{body}", f"<head><title>t</title><body>{body}", "<head>one two three four\n\nfive six",
        f'<div><svg class="i"/>{body}</div>', f'<div><svg class="i">{body}</div><svg></svg>', f"<div><button>{body}</div>", f"<div><p><button>like</p>{body}<button>x</button></div>",
        f"<button-bar>{body}</button-bar>", f"<title-box>{body}</title-box>", f"<div><svg><path/></svg><button>no</button><template><p>no</p></template>{body}<select><option>no</select></div>",
        f"<head><title>no</title><style>p {{}}</style><noscript>no</noscript></head><body>{body}</body>", f"<head/>{body}",
        f'<div class="col-12 col-md-4 sidebar"><p>no no no no no no no</p></div>{body}', f'<div class="a b has-sidebar">{body}</div>',
    ):
        got = html_text.main_text(page, {})
        assert got.split() == text.split() or got == f"like\n\n{text}", page


def test_class_names_of_content_are_no_asides():
    body = "<p>one two three four</p>"
    for page in (f'<main><div class="side-effects">{body}</div></main>', f'<article class="tags-history">{body}</article>', f'<article><div class="search-for-meaning">{body}</div></article>'):
        assert html_text.main_text(page, {}) == "one two three four", page
    for name in ("side-bar", "ad-slot", "share-buttons", "comments-area", "cookie_banner", "related-posts"):
        assert html_text.main_text(f'<article>{body}<div class="{name}"><p>no no no</p></div></article>', {}) == "one two three four", name


def test_best_part_is_the_best_of_all():
    g = np.random.default_rng(1)
    for n in (0, 1, 2, 9, 40):
        for _ in range(30):
            scores = g.integers(-6, 6, n).tolist()
            first, end = html_text.best_part(scores)
            assert sum(scores[first:end]) == max([0, *(sum(scores[i:j]) for i in range(n) for j in range(i + 1, n + 1))])


@pytest.mark.parametrize("unit", ["<div ", '<div "', "<div>", "</nav>", "<!", "<script ", "<a '<b \"", "<svg>", '<div class="x ', "<p><nav>", "</svg>"])
def test_broken_markup_takes_linear_time(unit):
    import time

    page = "<article><p>a b c</p>" + unit * (1_000_000 // len(unit))
    began = time.time()
    html_text.main_text(page, {})
    html_text.counted(page)
    assert time.time() - began < 20


def test_linear_without_both_classes():
    assert linear.fitted([]) is None and linear.scorer(None)(["a"]) == 1.0


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = docs
    for name, stage in p.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, "/root/testdata/sf0.001").persist()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count(), name
    assert kept.where(F.rlike("text", F.lit(personal.PATTERNS["email"]))).count() == 0
    assert {r.doc_id for r in p.STAGES[-1][1](spark, kept, "").collect()} == {r.doc_id for r in kept.collect()}


def test_filter_stages_keep_columns_and_take_odd_rows(spark, docs, empty):
    """Nulls, repeated rows, an empty table and columns with names of the operators' own."""
    from floeframe.llm.common import scratch, shared_dir

    odd = docs.withColumns({"score": F.lit(1), "row": F.lit("x"), "component_id": F.lit(2), "votes": F.lit("v")})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    before = set(os.listdir(shared_dir(spark) + "/floeframe"))
    with scratch(spark):
        for stage in (weak_labels.passed, lambda d: quality_rules.passed(d, labels), near_copies.one_of_each, personal.sanitised):
            assert stage(odd).columns == odd.columns
            assert stage(empty).count() == 0
        clean = personal.sanitised(odd)
        assert clean.count() == odd.count() and clean.where("text LIKE '%1.2.3.4%'").count() == 0
    assert set(os.listdir(shared_dir(spark) + "/floeframe")) == before
