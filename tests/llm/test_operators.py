"""Small fixtures against brute force, and the cases each docstring defines: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtrail.llm import decontaminate, html, lines, links, minhash, mixing, quality, secrets, shards, warc, words
from voxtrail.llm.components import connected_components
from voxtrail.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n, vocab=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocab}" for _ in range(n))


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]), with columns whose names the operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit(None).cast("string") for c in ("id", "key", "label", "size", "rules", "row", "kept", "shard", "target", "gone")})


@pytest.fixture(scope="module")
def hard(spark):
    base = prose(1, 200)
    near = base.split()
    near[100] = "changed"
    return docs(spark, [(1, base), (2, base), (3, " ".join(near)), (3, " ".join(near)), (4, None), (None, ""), (None, base), (5, " \t\n"), (6, prose(2, 60_000)), (7, "one two"), (8, "ONE two"), (9, prose(3, 80), None, None)])


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# words


def test_word_hashes_depend_on_the_word_alone():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(3000)).encode()
    got = words.word_hashes(b"\n " + text * 2 + b"\t")
    seen = {}
    for w, h in zip((text * 2).split(), got.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(words.word_hashes(b"")) == 0
    old, words.PIECE = words.PIECE, 64
    try:
        assert (words.word_hashes(text) == words.word_hashes(text)).all() and len(words.word_hashes(text)) == 3000
    finally:
        words.PIECE = old


# near duplicates


def brute_components(rows, percent=85):
    def shingle(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingle(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    return [(r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def test_minhash_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 6)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(7)
    rows, k = [], 0
    for group in range(6):
        base = prose(group + 10, 150, 5000).split()
        for _ in range(25):
            t = list(base)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
            rows.append((k, " ".join(t)))
            k += 1
    rows += [(900 + i, prose(50 + i, n)) for i, n in enumerate((1, 2, 4, 5, 6, 300))] + [(950, rows[0][1]), (None, rows[1][1]), (951, ""), (952, None)]
    got = minhash.near_duplicates(docs(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect() if r.doc_id is not None)


def test_minhash_edge_cases(spark, hard):
    got = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(hard).collect()}
    assert got[(3, 196)].component_id == 1 and got[(None, 196)].component_id == 1 and got[(8, 1)].component_id == 7
    assert got[(4, 0)].component_id == 4 and got[(4, 0)].kept and got[(5, 0)].kept
    left = minhash.drop_near_duplicates(hard)
    assert left.columns == hard.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, i) for i in (1, 4, 5, 6, 7, 9)] + [(True, 0)]
    assert minhash.drop_near_duplicates(hard.limit(0)).count() == 0


def test_null_ids_are_no_minus_ones(spark):
    text = prose(1, 50)
    df = docs(spark, [(-1, text), (None, text), (7, prose(2, 50)), (None, prose(3, 50)), (None, prose(3, 50))]).withColumns({"__text": F.lit("t"), "__at": F.lit("a"), "none": F.lit("n")})
    got = minhash.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted(rows_of(got, "doc_id", "__text", "__at"), key=repr) == sorted([(-1, "t", "a"), (7, "t", "a"), (None, "t", "a")], key=repr)
    scores = minhash.near_duplicates(df)
    assert rows_of(scores.where("doc_id is null and n_shingles = 46"), "component_id", "kept") == [(-1, False), (None, True), (None, True)]


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(minhash, "HUB", 3)
    base = [prose(i, 120, 5000) for i in range(3)]
    rows = [(10 * i + j, b + f" x{j} y{j}") for i, b in enumerate(base) for j in range(9)]
    assert rows_of(minhash.near_duplicates(docs(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows), key=repr)


def test_repeated_rows_leave_one(spark):
    df = docs(spark, [(1, prose(1, 50)), (1, prose(1, 50)), (1, prose(2, 50)), (None, prose(3, 50)), (None, prose(4, 50)), (2, ""), (2, "")])
    assert minhash.drop_near_duplicates(df).count() == 6


def test_near_dedup_stage_links_at_080(spark):
    import corpus_pipeline

    rows = []
    for pair in range(12):
        base = [f"p{pair}w{i}" for i in range(150)]
        t = list(base)
        for e in range((3, 3, 4)[pair % 3]):  # similarities of 131 / 161 = 0.81 and 126 / 166 = 0.76
            t[20 + 30 * e] = f"x{e}"
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(t))]
    want = sorted(i for i, _, root in brute_components(rows, 80) if i == root)
    assert len(want) == 16 and len({root for _, _, root in brute_components(rows)}) == 24
    df = docs(spark, rows)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == want == sorted(r.doc_id for r in minhash.drop_near_duplicates(df).collect())


def test_sketch_fills_every_coordinate():
    for n in (1, 2, 3, 20, 1000):
        s = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        c = minhash.sketch(s)
        assert len(c) == minhash.T and (c == minhash.sketch(s)).all()
        assert (minhash.band_keys(c) == minhash.band_keys(c)).all()


def test_forest_connects_what_the_links_connect():
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 1), (1, 2), (0, 2), (4, 5)):
        linked[a, b] = linked[b, a] = True
    assert len(minhash.forest(linked)) == 3


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = dict(rows_of(connected_components(edges, Scratch(spark, "t")), "id", "label"))
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100


# decontamination


def edited(rng, words, share, kinds, vocab):
    words = list(words)
    for _ in range(int(share * len(words))):
        kind, at = rng.choice(kinds), rng.randrange(len(words))
        words[at : at + (kind != "insert")] = [] if kind == "delete" else [rng.choice(vocab)]
    return words


@pytest.mark.parametrize("share, kinds, least", [(0.1, ("replace",), 0.99), (0.2, ("replace",), 0.95), (0.2, ("replace", "insert", "delete"), 0.95)])
def test_recall_at_the_bound(share, kinds, least):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(3000)] + [f"common{i}" for i in range(20)] * 40
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(14, 60)))) for i in range(200)]
    index = decontaminate.Index.load(decontaminate.Index([(i, t.encode()) for i, t in items]).state())
    texts, planted = [], []
    for i, t in items * 2:
        text = rng.choices(vocab, k=120)
        at = rng.randrange(120)
        text[at:at] = edited(rng, t.split(), share, kinds, vocab)
        texts.append(" ".join(text).encode())
        planted.append(i)
    got = index.search(texts)
    assert sum(any(x[0] == i for x in found) for i, found in zip(planted, got)) >= least * len(planted)


def test_leaks_against_all_items_and_texts(spark):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 60)))) for i in range(30)]
    rows = []
    for d in range(120):
        t = rng.choices(vocab, k=rng.randint(1, 200))
        for i in rng.sample(range(30), d % 3):
            w = edited(rng, items[i][1].split(), rng.choice((0, 0.1, 0.15, 0.3)), ("replace", "insert", "delete"), vocab)
            at = rng.randrange(len(t) + 1)
            t[at:at] = [x.upper() + "," for x in w] if d % 2 else w
        rows.append((d, " ".join(t)))
    bench = spark.createDataFrame(items + [(None, None), (99, "  "), (0, items[0][1])], "item_id long, text string")
    found = decontaminate.leaks(docs(spark, rows), bench).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    want = {}
    for d, t in rows:
        for i, x in items:
            item, text = decontaminate.tokens(x.encode()), decontaminate.tokens(t.encode())
            least = decontaminate.distance(item, text)[0]
            if least <= int(0.2 * len(item)):
                want[(d, i)] = least
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.98 * len(want) and len(want) > 60
    left = decontaminate.drop_leaks(docs(spark, rows), bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_many_items_go_in_several_passes(spark, hard, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 200)
    words = prose(1, 200).split()
    bench = spark.createDataFrame([(i, " ".join(words[10 * i : 10 * i + 30])) for i in range(8)], "item_id long, text string")
    found = decontaminate.leaks(hard.where("doc_id = 1"), bench)
    assert {r.item_id for r in found.collect() if not r.distance} == set(range(8)) and decontaminate.drop_leaks(hard, bench).columns == hard.columns


def test_leak_edges(spark, hard):
    item = " ".join(prose(1, 200).split()[50:90])
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = decontaminate.leaks(hard, bench)
    assert rows_of(found, "doc_id", "item_words", "distance") == sorted([(1, 40, 0), (2, 40, 0), (None, 40, 0), (3, 40, 0), (3, 40, 0)], key=repr)
    assert {(r.start_word, r.end_word) for r in found.collect()} == {(50, 90)}
    assert decontaminate.leaks(hard, bench.limit(0)).count() == 0 and decontaminate.leaks(hard.limit(0), bench).count() == 0


def test_distance_is_the_least_over_all_stretches():
    def brute(item, text):
        best = len(item)
        for i in range(len(text) + 1):
            for j in range(i, len(text) + 1):
                row = list(range(j - i + 1))
                for a in item:
                    new = [row[0] + 1]
                    for k, b in enumerate(text[i:j]):
                        new.append(min(row[k] + (a != b), row[k + 1] + 1, new[-1] + 1))
                    row = new
                best = min(best, row[-1])
        return best

    rng = random.Random(2)
    for _ in range(40):
        item, text = np.array(rng.choices(range(4), k=5)), np.array(rng.choices(range(4), k=rng.randint(1, 9)))
        assert decontaminate.distance(item, text)[0] == brute(item.tolist(), text.tolist())


# quality


def test_quality_counts_against_brute_force(spark, hard):
    def brute(t):
        w = WORD.findall(t or "")
        n, covered = collections.Counter(zip(w, w[1:], w[2:])), set()
        for i, x in enumerate(zip(w, w[1:], w[2:])):
            if n[x] > 1:
                covered |= {i, i + 1, i + 2}
        ls = [x for x in (t or "").split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(ls) - len(set(ls)), len(covered)

    rows = [(1, "a b c a b c d\na b\n\n a b\na b é€ #*"), (2, None), (3, ""), (4, "x " * 70), (5, prose(1, 500))]
    got = {r.doc_id: r for r in quality.quality_scores(docs(spark, rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
    assert got[2].base_failed and not got[2].kept and got[4].base_failed
    assert quality.quality_scores(hard.limit(0)).count() == 0 and quality.keep_good(hard.limit(0)).count() == 0


def language_prose(seed, n, lang="en"):
    """Words as often as the references say, in sentences."""
    rng = random.Random(seed)
    weights = quality.REFERENCES[lang][1]
    words = []
    for i in range(n):
        k = rng.choices(range(len(weights)), weights)[0]
        w = quality.COMMON_WORDS[lang][k] if k < len(weights) - 1 else "".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 8)))
        words.append((w.capitalize() if i % 10 == 0 else w) + ("." if i % 10 == 9 else ""))
    return " ".join(words)


def test_divergence_rejects_junk_and_keeps_prose(spark):
    rng = random.Random(1)
    good = [(i, language_prose(i, 200, lang), lang) for i, lang in enumerate(("en", "de", "fr", "es") * 5)]
    junk = [(100 + i, " ".join("".join(rng.choices("#*$%&|<>0123456789", k=5)) for _ in range(200)), "en") for i in range(3)]
    odd = [(200 + i, " ".join("".join(rng.choices("etaoinshrdlu", k=6)) for _ in range(200)), "de") for i in range(3)]
    df = docs(spark, good + junk + odd)
    kept = {r.doc_id for r in quality.keep_good(df).collect()}
    assert kept == {r[0] for r in good} == {r.doc_id for r in quality.quality_scores(df).where("kept").collect()}
    # a verdict doesn't depend on what else the table holds
    assert quality.keep_good(docs(spark, odd + junk)).count() == 0 and quality.keep_good(docs(spark, good[:1])).count() == 1
    assert quality.js_distance([1, 0], [0, 1]) == pytest.approx(1) and quality.js_distance([2, 2], [1, 1]) == 0


def test_quality_verdicts_against_brute_force(spark, hard):
    import math

    def distance(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        kl = lambda a, m: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
        m = [(x + y) / 2 for x, y in zip(p, q)]
        return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))

    def brute(t, lang):
        w = WORD.findall(t or "")
        forms = {k: [{x, x.capitalize(), x.upper()} for x in v] for k, v in quality.COMMON_WORDS.items()}
        if lang not in forms:
            lang = max(forms, key=lambda k: sum(x in f for x in w for f in forms[k]))
        kinds = [len(re.findall(r, t or "")) for r in ("[a-z]", "[A-Z]", "[0-9]", r"[ \t\n\x0b\x0c\r]", r"[#*$%&|<>]", r"""[.,;:!?'"()-]""")]
        beyond = sum(ord(c) > 127 for c in t or "")
        kinds += [len(t or "") - sum(kinds) - beyond, beyond]
        common = [sum(x in f for x in w) for f in forms[lang]]
        common.append(len(w) - sum(common))
        far = len(t or "") >= 300 and distance(kinds, quality.REFERENCES[lang][0]) > quality.MAX_CLASS_DISTANCE
        return lang, not far and not (len(w) >= 100 and distance(common, quality.REFERENCES[lang][1]) > quality.MAX_WORD_DISTANCE)

    rng = random.Random(3)
    rows = [(i, language_prose(i, rng.randint(20, 300), rng.choice(("en", "de", "fr"))) + " #$%" * rng.randint(0, 60) + " é" * rng.randint(0, 40), rng.choice(("en", "de", "es", None, "xx"))) for i in range(60)]
    got = {r.doc_id: r for r in quality.quality_scores(docs(spark, rows)).collect()}
    for i, t, lang in rows:
        said, fine = brute(t, lang)
        assert got[i].language == said and got[i].kept == (fine and not got[i].base_failed)
    assert len({r.kept for r in got.values()}) == 2
    assert quality.keep_good(hard).columns == hard.columns


# mixing


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randint(0, 200)), "en", None if i % 50 == 0 else f"s{min(4, i % 7)}") for i in range(600)]
    got = mixing.mix(docs(spark, rows)).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    assert all(taken[s] == round(target[s]) for s in size)
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    names = sorted(x for x in size if x is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal, capped = {}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        goal = {s: 3 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names}
        over = {s for s in names if s not in capped and goal[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    assert all(target[s] == pytest.approx(goal[s]) for s in names)
    assert rows_of(mixing.mix(docs(spark, rows)), "doc_id", "taken") == rows_of(mixing.mix(docs(spark, list(reversed(rows)))), "doc_id", "taken")


def test_mixed_documents_are_whole(spark, hard):
    rows = [(i, prose(i, 20 + i), "en", "a" if i < 30 else "b") for i in range(200)]
    df = docs(spark, rows)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    texts, n = {r[0]: r[1] for r in rows}, collections.Counter()
    for r in out.collect():
        assert r.text == texts[r.doc_id]
        n[r.source] += len(r.text.split())
    goal = {r.source: r.target for r in mixing.mix(df).collect()}
    assert all(abs(n[s] - goal[s]) <= 230 for s in goal)
    assert mixing.mix(hard.limit(0)).count() == 0 and mixing.mix_documents(hard.limit(0)).count() == 0
    assert mixing.mix(hard).count() == hard.count()


# sharding


def new_store(spark, **options):
    return shards.ShardStore(spark, Scratch(spark, "test-store").path("s"), 1 << 20, **options)


def test_shards_round_trip_and_compact(spark, hard):
    odd = hard.withColumns({"name": F.lit("n"), "_metadata": F.lit("m"), "__name": F.lit("x")})
    store = new_store(spark)
    store.append(odd.repartition(6), arrival_rows=1)
    store.compact()
    rows = store.read()
    assert rows_of(rows.drop("shard_"), *odd.columns) == rows_of(odd, *odd.columns)
    assert rows.columns == [*odd.columns, "shard_"]
    version, _, left = store.manifest()
    assert version >= 2 and len(left) < len(store.manifest(1)[2]) and sum(s.rows for s in left) == hard.count()
    assert rows_of(store.read(1), "doc_id", "text") == rows_of(hard, "doc_id", "text")  # an old version stays readable after a merge
    private, rows = shards.shard_documents(hard.repartition(6), target_bytes=1 << 20, arrival_rows=1)
    assert len(private.versions()) == 1 and rows_of(rows, "doc_id", "text") == rows_of(hard, "doc_id", "text")
    assert shards.shard_documents(hard.limit(0))[1].count() == 0


def test_manifests_are_committed_once(spark, hard):
    store = new_store(spark)
    store.append(hard)
    state = store.state()
    late = store._write(hard, "run-late")  # another writer has finished its files, but not its commit
    store.append(hard)
    store.compact()
    store.vacuum()
    with pytest.raises(shards.ManifestConflict):
        store.commit(state, state.schema, late)
    store.commit(store.state(), state.schema, late)
    assert store.read().count() == 3 * hard.count()
    store.retain, store.min_age = 1, 0
    store._write(hard, "run-lost")
    gone = store._write(hard, "run-gone")
    store.vacuum()
    assert store.read().count() == 3 * hard.count() and len(store.versions()) == 1
    with pytest.raises(FileNotFoundError):
        store.commit(store.state(), state.schema, gone)
    with pytest.raises(ValueError):
        store.append(hard.withColumn("more", F.lit(1)))


def test_a_lost_race_is_run_again(spark, hard):
    store, other = new_store(spark), None
    commit = store.commit

    def late(state, *rest):
        nonlocal other
        if other is None:
            other = shards.ShardStore(spark, store.root, 1 << 20)
            other.append(hard)
        return commit(state, *rest)

    store.commit = late
    store.append(hard)
    assert store.read().count() == 2 * hard.count() and store.versions() == [1, 2]
    store.append(hard.repartition(8), arrival_rows=1)
    other = None
    store.compact()
    assert store.read().count() == 4 * hard.count() and len(store.manifest()[2]) < 8


def test_segments_are_shared(spark, hard, monkeypatch):
    monkeypatch.setattr(shards, "SEGMENT", 3)
    store = new_store(spark)
    store.append(hard.repartition(8), arrival_rows=1)
    one = store.state()
    store.append(hard.limit(1))
    two = store.state()
    assert len(one.segments) >= 3 and set(one.segments) < set(two.segments)
    assert store._due([shards.Shard(f"p{i}", 5, 1) for i in range(4)])[0].path == "p0"  # ties go by path


# archives


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2\n", "same"), (3, None, None), (4, "http://a/4", ""), (None, "http://a/n", "same"), (5, "http://b/5", "x" * 300_000), (5, "http://b/5", "x" * 300_000), (None, "u", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("first", F.lit(2))
    path = f"file://{tmp_path}/w"
    warc.archive_pages(df, path)
    got = rows_of(warc.archived_pages(spark, path), "page_id", "payload_bytes", "record_type", "refers_to")
    assert got == sorted([(1, 4, "revisit", 2), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (None, 4, "revisit", 2), (5, 300_000, "response", None), (5, 300_000, "response", None), (None, 5, "response", None)], key=repr)
    full = warc.read_warc(spark, path).where("record_type = 'response' and target_uri like 'http://b/%'")
    assert {bytes(r.payload) for r in full.collect()} == {b"x" * 300_000}
    plan = full._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith" not in plan.split("BatchScan")[0]
    warc.archive_pages(df.limit(0), f"file://{tmp_path}/e")
    assert warc.archived_pages(spark, f"file://{tmp_path}/e").count() == 0


def test_foreign_archives(spark, tmp_path):
    import gzip

    rec = [warc.record("response", f"urn:page:{i}", f"http://h/{i}", None, b"p" * i) for i in range(5)]
    (tmp_path / "a.warc").write_bytes(b"".join(rec))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in rec))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(rec)))  # all records in one member
    (tmp_path / "d.warc.gz").write_bytes(warc.member(rec[0]) + warc.member(rec[1]) + warc.member(rec[2] + rec[3]) + gzip.compress(rec[4].replace(b"WARC-Type", b"warc-type")))
    read = lambda: warc.read_warc(spark, f"file://{tmp_path}", verify="true")
    assert rows_of(read().where("record_id = 'urn:page:3'"), "payload_bytes", "payload_digest") == [(3, warc.digest(b"ppp"))] * 4
    assert read().count() == 20


@pytest.mark.parametrize("name, data", [("a.warc", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort"), ("a.warc", b"no record at all"), ("a.warc", b"no record\r\n\r\nat all"), ("a.warc", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"), ("a.warc.gz", b"plain text, not gzip"), ("a.warc.gz", "cut")])
def test_broken_archives_are_errors(tmp_path, name, data):
    import gzip

    if data == "cut":
        data = gzip.compress(warc.record("response", "x", None, None, b"p" * 9))[:-20]
    (tmp_path / name).write_bytes(data)
    for wanted in (True, False):
        reader = warc.WarcReader({"path": str(tmp_path)})
        reader.wanted = lambda headers: wanted
        with pytest.raises(Exception):
            list(reader.read(warc.FilePartition(f"{tmp_path}/{name}")))


# lines


def test_lines_against_all_runs(spark):
    rng = random.Random(9)
    pool = [prose(i, rng.randint(1, 30)) for i in range(30)] + [""]
    rows = [(d, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for d in range(60)] + [(70, None), (71, ""), (72, "\n".join(["a b c"] * 40))]
    first, runs, gone = {}, [], collections.defaultdict(set)
    for d, t in rows:
        ls = [(k, x, len(WORD.findall(x))) for k, x in enumerate((t or "").split("\n"))]
        ls = [x for x in ls if x[2]]
        for i in range(len(ls)):
            total = 0
            for j in range(i, len(ls)):
                total += ls[j][2]
                if total >= 50:
                    key = tuple(x[1] for x in ls[i : j + 1])
                    first.setdefault(key, (d, ls[i][0]))
                    runs.append((key, d, ls[i][0], ls[j][0]))
    for key, d, a, b in runs:
        if first[key] < (d, a):
            gone[d] |= set(range(a, b + 1))
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, rows)).collect()}
    for d, t in rows:
        if t is None:
            assert got[d].text is None and got[d].n_lines == 0
        else:
            assert got[d].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d])
            assert got[d].n_removed == len(gone[d])


def test_lines_over_ranges_and_hot_keys(spark, monkeypatch):
    from voxtrail.llm import common

    monkeypatch.setattr(lines, "RANGE_ROWS", 7)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "MOST_HOT", 10**9)
    test_lines_against_all_runs.__wrapped__(spark) if hasattr(test_lines_against_all_runs, "__wrapped__") else test_lines_against_all_runs(spark)


def test_ranks_order_all_suffixes(spark):
    rng = random.Random(2)
    rows = [(d, "\n".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))) for d in range(12)] + [(20, "a\n" * 70)]
    scratch = Scratch(spark, "ranks")
    numbered = lines.numbered_lines(docs(spark, rows), scratch, "doc_id", "text")
    got = lines.suffix_ranks(numbered, scratch, 50).collect()
    ids = {(r.row, r.pos): r.id for r in got}
    suffix = lambda r: tuple(ids[(r.row, p)] for p in range(r.pos, r.pos + min(64, r.left)))
    ordered = sorted(got, key=lambda r: r["rank"])
    keys = [suffix(r) for r in ordered]
    assert keys == sorted(keys) and all((a["rank"] == b["rank"]) == (suffix(a) == suffix(b)) for a, b in zip(ordered, ordered[1:]))


def test_lines_edges(spark, hard):
    got = lines.dedup_lines(hard)
    texts = collections.defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append(r.text)
    assert texts[2] == [""] and texts[1] != [""] and sorted(texts[None]) == ["", ""] and texts[4] == [None] and len(texts[3]) == 2
    assert lines.dedup_lines(hard.limit(0)).count() == 0


# html

PAGE = """<html><head><title>T</title><style>x</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><a>Home</a></nav>
<div class="cookie-notice">We use</div>{body}<aside>Side</aside><section id="comments"><article>Reader words that go on and on for a while</article></section><form>Name</form><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("body", ["<article><h1>Title</h1><p>First &amp; best,   with\n words<p><b>Second<br>half &eacute;</b></p><div class=ad>Buy</div><p>No.</p></article>", "<main><h1>Title</h1><p>First &amp; best, with words<p>Second half &eacute;<p>No.</main>", "<div class=body><div><h1>Title</h1><p>First &#38; best, with words</p><p>Second half é</p><p>No.</p></div></div>"])
def test_main_text(body):
    assert html.main_text(PAGE.format(body=body)) == "Title\nFirst & best, with words\nSecond half é\nNo."


def test_main_text_of_several_regions():
    long, short = [f"{i} " + "long line of words " * 6 for i in range(9)], "the end of it, in fewer words than before it"
    ps = lambda xs: "".join(f"<p>{x}</p>" for x in xs)
    text = "\n".join(" ".join(x.split()) for x in [*long, short])
    for body in (f"<div><section>{ps(long)}</section><section>{ps([short])}</section></div>", f"<article>{ps(long)}</article><article>{ps([short])}</article>", f"<div><blockquote>{ps(long)}</blockquote>{ps([short])}</div>"):
        assert html.main_text(f"<body><nav>x</nav>{body}</body>") == text
    for tag in ("pre", "ul", "table"):
        assert html.main_text(f"<body><div>{ps([short])}<{tag}>{long[0] * 9}</{tag}></div></body>").startswith(short)


def test_inline_adverts_links_and_wrappers():
    text = html.main_text
    assert text('<article><p>Some text here, <span class="ad">buy <span>now</span> LEAKED</span> and on.</p></article>') == "Some text here, and on."
    assert text('<article><p>Words before <a class="share-link">a shared</a> link.</p><p>More.</p></article>') == "Words before a shared link.\nMore."
    long = "Long words of text. " * 9
    for wrapper in ("widget-page content", "widget-page"):
        assert text(f'<div class="{wrapper}"><p>{long}</p><p>More.</p></div>') == f"{long.strip()}\nMore."
    assert text(f"<main><div><a>Teaser one</a></div><article><header><h1>Head</h1></header><p>{long}</p><p>End.</p></article></main>") == f"{long.strip()}\nEnd."
    assert text(f'<article><p>{long}</p></article><div class="comments"><p>{long * 9}</p></div>') == long.strip()
    assert text("<p>One <button>press</button> two</p>") == "One two"


def test_clusters_choose_the_lines():
    long = "Long words of a text that goes on. " * 8
    body = f"<body><div><a>Home page</a> <a>About</a> <a>Contact</a></div><div><h2>Title</h2><p>{long}</p><p>Of.</p><p>{long}</p></div><div><a>Next one</a> <a>Prior</a></div></body>"
    want = f"Title\n{long.strip()}\nOf.\n{long.strip()}"
    assert html.main_text(body) == want
    everything = html.main_text(body, lambda ratio, links: ratio >= 0)
    assert everything != want and everything.startswith("Home page")
    # of regions alike the page's order decides nothing: all of them stay
    assert html.main_text(f"<article><p>{long}</p></article><article><p>{long}</p></article>") == f"{long.strip()}\n{long.strip()}"


def test_deep_pages_take_linear_time():
    import time

    took = []
    for n in (2000, 8000):
        start = time.perf_counter()
        assert html.main_text("<div>" * n + "text of it" + "</div>" * n) == "text of it"
        html.main_text("<p><i>a " * n + "</b>" * n)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 0.5


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "plain text"), (None, "u", "<article><p>cut o"), (5, "u", "<![odd x]><p>text</p>"), (6, "u", "<p>" + "long word " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html.extract(df).collect()}
    assert [got[i].text for i in (1, 2, 3, 4, None)] == ["", "", "", "plain text", "cut o"]
    assert "text" in got[5].text and got[6].n_chars == 499_999 and html.extract(df.limit(0)).count() == 0


# urls


def page(*to):
    return "".join(f'<a href="{t}">x</a>' for t in to)


def brute_scores(edges, seeds, damping=0.85, rounds=300):
    home = {s: 1 / len(seeds) for s in seeds}
    score = dict(home)
    for _ in range(rounds):
        new = collections.Counter({s: (1 - damping) * x for s, x in home.items()})
        for u, to in edges.items():
            for v, n in to.items():
                new[v] += damping * score.get(u, 0) * n / sum(to.values())
        score = new
    return score


def test_seeds_come_from_rules_and_a_table(spark):
    rows = [(1, "http://bad.com/en/1", ""), (2, "http://bad.com/en/2", ""), (3, "http://bad.com/fr/", ""), (4, "http://half.com/en/1", ""), (5, "http://half.com/fr/1", ""), (6, "http://fine.net/de/1", page("http://liked.info/")), (7, "http://liked.info/", "")]
    rows += [(8, "http://linker.info/", page("http://www.Pills.biz/a")), (9, "http://plain.info/", page("http://other.biz/")), (10, "http://BAD.com:80/fr", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seeds = spark.createDataFrame([("WWW.pills.biz", "d"), ("fine.net", "t")], "host string, kind string")
    got = {r.page_id: r for r in links.judge(df, seeds=seeds).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow"}
    assert got[8].distrust == pytest.approx(0.85 * 0.15 / 2) and got[7].trust == pytest.approx(0.85 * 0.15) and got[9].distrust == 0
    assert {r.page_id: r.verdict for r in links.judge(df, rules=(), seeds=seeds.limit(0)).collect()} == dict.fromkeys(range(1, 11), "allow")


def test_scores_converge(spark):
    edges = {"a": {"b": 2, "c": 1}, "b": {"a": 1}, "c": {"a": 1, "d": 3}, "d": {"c": 1}}
    table = spark.createDataFrame([(u, v, n) for u, to in edges.items() for v, n in to.items()], "source string, target string, links long")
    seeds = spark.createDataFrame([("a", "t"), ("d", "d"), ("d", "d")], "host string, kind string")
    got = {r.host: r for r in links.propagate(table, seeds, Scratch(spark, "t"), tolerance=1e-3).collect()}
    back = collections.defaultdict(dict)
    for u, to in edges.items():
        for v, n in to.items():
            back[v][u] = n
    trust, distrust = brute_scores(edges, ["a"]), brute_scores(back, ["d"])
    for h in edges:
        assert got[h].trust == pytest.approx(trust[h], abs=0.01) and got[h].distrust == pytest.approx(distrust[h], abs=0.01)


def test_rules_and_propagation(spark):
    rows = [(1, "http://WWW.Example.com/en/7?x", page("http://good.org/")), (2, "https://a.com/en/", None), (3, "http://good.org/fr", page("//fine.org/x")), (4, "http://fine.org/", ""), (7, None, None), (8, "nothing", None), (9, "http://x.net/de/8#f", None), (10, "http://example.net/de/8", None), (None, "http://notexample.com/en/7", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "said": F.lit("clash"), "kind": F.lit("clash")})
    got = {r.page_id: r for r in links.judge(df).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[2].verdict == "block" and got[9].rule == "net/de/" and got[10].rule == "example.net/de/8" and got[None].rule == "com/en/"
    assert (got[7].host, got[7].path, got[7].verdict, got[8].host) == ("", "", "allow", "")
    score = brute_scores({"www.example.com": {"good.org": 1}, "good.org": {"fine.org": 1}}, ["www.example.com", "x.net"])
    assert got[3].trust == pytest.approx(score["good.org"], abs=1e-5) and got[4].trust == pytest.approx(score["fine.org"], abs=1e-5)
    assert links.judge(df.limit(0)).count() == 0


# secrets


def brute_spans(t):
    kinds = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]
    return sorted((m.start(), i, m.end()) for i, (_, p, g, n) in enumerate(kinds) for m in p.finditer(t or "") if len(m[g]) >= n)


def test_secrets_against_full_scan(spark):
    rng = random.Random(8)
    bits = ['password = "abcdefgh"', "ToKeN:short", "token=secret:abcdefghij", "api_key='aaaa.bbbb-cc'", "APIKEY==x=y=zzzzzz", "AKIA" + "A1B2" * 4, "AKIAshort", "ab12" * 9, "deadbeef", "é€ \U0001f600", "pass word", "my secret", "\n", "passwd: \x20 hunter2hunter2", "x" * 50]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randint(0, 12)))) for i in range(150)] + [(None, None), (7, ""), (8, "token=" + "a" * 100_000), (8, "token=" + "a" * 100_000)]
    out = secrets.digest(secrets.scan(docs(spark, rows))).collect()
    want = collections.Counter()
    for i, t in rows:
        s = brute_spans(t)
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in s)
        want[(i, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert want == collections.Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out)
    assert secrets.scan(docs(spark, rows).limit(0)).count() == 0


def test_trigram_queries_are_necessary():
    def holds(q, t):
        return {"all": lambda: True, "gram": lambda: q[1] in t, "and": lambda: all(holds(x, t) for x in q[1]), "or": lambda: any(holds(x, t) for x in q[1])}[q[0]]()

    cases = {"abc+d?ef": ["abcef", "abccdef"], "(foo|ba?r)baz": ["foobaz", "brbaz", "barbaz"], "x[0-9]{2}yzw": ["x12yzw"], "(ab)*cde": ["cde", "ababcde"], "[Aa][Bb][Cc]x*": ["aBc"], "hex[0-9a-f]+": ["hex0"], ".*": [""], "a|bcd": ["a", "bcd"]}
    for regex, texts in cases.items():
        q = secrets.trigram_query(regex)
        assert all(re.search(regex, t) and holds(q, t.lower()) for t in texts)
    assert secrets.trigram_query("[0-9a-f]+") == secrets.ALL and secrets.trigram_query("abcd") != secrets.ALL


# pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, language_prose(i, 120), "en", f"s{i % 3}", 1) for i in range(60)]
    item = " ".join(f"leak{i}" for i in range(30))
    rows += [(100, rows[0][1], "en", "s0", 1), (101, "too short", "en", "s0", 1), (102, language_prose(102, 120) + " " + item, "en", "s1", 1)]
    rows += [(None, language_prose(103, 120), None, None, None), (None, language_prose(103, 120), None, None, None), (-1, language_prose(103, 120), "en", "s0", 1), (104, None, None, None, None), (105, "", "", "", 0), (106, language_prose(106, 30_000), "en", "s2", 1)]
    clash = ("at", "none", "key", "own", "epochs", "cut", "copies", "shard", "name", "__text", "__copies", "_metadata")
    full = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in clash})
    spark.createDataFrame([(1, item), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    # the stages by brute force
    good = [r for r in rows if quality.judge((r[1] or "").encode(), r[2])[-1]]
    roots = brute_components(good, 80)
    first = {}
    for r, (_, _, root) in zip(good, roots):
        if r[0] == root or root is None:
            first.setdefault((root, r[1] if root is None else ""), r)
    single = list(first.values())
    clean = [r for r in single if item not in r[1]]
    want = [{r[0] for r in x} for x in (good, single, clean)]

    df, kept = full, []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        out.write.mode("overwrite").parquet(f"{tmp_path}/stage{len(kept)}")
        df = spark.read.parquet(f"{tmp_path}/stage{len(kept)}")
        got = df.collect()
        kept.append({r.doc_id for r in got})
        assert out.columns[: len(full.columns)] == full.columns and all(r[c] == c + ("" if r.doc_id is None else str(r.doc_id)) for r in got for c in clash)
    assert kept[:3] == want and kept[0] >= {None, -1, 106} and -1 in kept[1] and not kept[1] & {100, None}
    assert kept[4] == kept[3] <= want[2] and len(kept[3]) > 30
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, full.limit(0), str(tmp_path)).count() == 0
