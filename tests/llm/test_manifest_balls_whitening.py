"""Merkle manifest, ball hashing and whitening against brute force, with odd rows."""

import hashlib
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rowferry.llm import ballhash, merkle, whitening

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, node string, _tree string, fp string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields):
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def levels_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def steps_of(levels, i, fanout):
    for level in levels[:-1]:
        lo = i - i % fanout
        yield level[lo:i], level[i + 1 : lo + fanout]
        i //= fanout


def brute_manifest(rows, fanout):
    trees = defaultdict(list)
    for r in rows:
        claim = list(r[:3]) + [r[3] if r[3] is None else r[3] + 1, r[4]]
        altered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        trees[r[2]].append((r[0], leaf_of(r[:5]), leaf_of(claim) if altered else leaf_of(r[:5])))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in order:
        trees[k].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    lower = {k: levels_of([t[1] for t in trees[k]], fanout) for k in order}
    upper = levels_of([lower[k][-1][0] for k in order], fanout)
    out = []
    for j, k in enumerate(order):
        for i, (doc, leaf, claim) in enumerate(trees[k]):
            steps = [*steps_of(lower[k], i, fanout), *steps_of(upper, j, fanout)]
            for before, after in steps:
                claim = sha(*before, claim, *after)
            proof = sha(*[h for before, after in steps for h in before + after])
            out.append((doc, leaf, lower[k][-1][0], upper[-1][0], proof, claim, claim == upper[-1][0]))
    return sorted(out, key=repr)


def documents(n):
    langs = ["en", "en", "de", None, "", "zz", "é", "fr"]
    rows = [(i * 3 % 1009, "s" if i % 5 else None, "en" if i % 3 else langs[i % 8], None if i % 11 == 0 else i, None if i % 13 == 0 else f"tëxt {i} " * (i % 4)) for i in range(n)]
    rows += [rows[4], rows[4], (None, "s", "en", 3, "no id"), (None, "s", "en", 4, "no id"), (7, "s", "en", 1, "same id"), (2**62, None, None, 2**63 - 1, "x" * 100_000), (14, "s", "only", -1, "")]
    return rows


@pytest.mark.parametrize("fanout, levels, n", [(2, 2, 150), (3, 1, 100), (2, 12, 60), (2, 0, 40)])
def test_manifest(spark, fanout, levels, n):
    rows = documents(n)
    docs = spark.createDataFrame([(*r, "t", "n", "u", "f") for r in rows], DOCS)
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    out = merkle.manifest(merkle.document_leaves(docs, altered), fanout, levels)
    got = [tuple(r) for r in out.select("at", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(got, key=repr) == brute_manifest(rows, fanout)


def test_manifest_proofs_are_whole(spark):
    docs = spark.createDataFrame([(*r, "t", "n", "u", "f") for r in documents(50)], DOCS)
    out = merkle.manifest(merkle.document_leaves(docs), 2, 2, with_proofs=True).collect()
    assert all(r["verified"] and r["proof_sha256"] == sha(*[h for level in r["proof"] for h in level]) for r in out)


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.manifest(merkle.document_leaves(spark.createDataFrame([], DOCS))).count() == 0
    row = (1, "s", "en", 1, "t")
    one = merkle.manifest(merkle.document_leaves(spark.createDataFrame([(*row, "", "", "", "")], DOCS))).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["verified"]) for r in one] == [(leaf_of(row),) * 3 + (sha(), True)]


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            parent[root(i)] = root(j)
    low = defaultdict(lambda: None)
    for i, doc in enumerate(ids):
        if doc is not None and (low[root(i)] is None or doc < low[root(i)]):
            low[root(i)] = doc
    return [low[root(i)] for i in range(len(fps))]


def test_fingerprints():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["Ab", "c", "ÉF", "g7"], n)) for n in (1, 2, 3, 4, 50, 700)] + [None, "", " \t\n", "a\x0bB\x0cc\rd  e f"]
    long = " ".join(f"w{i % 97}" for i in range(70_000))
    got = ballhash.fingerprints([None if t is None else t.encode() for t in [*texts, long]])
    assert got.tolist() == [brute_fingerprint(t) for t in [*texts, long]]


def near_texts():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for g in range(30):
        base = rng.choice(words, 300)
        for c in range(6):
            own = base.copy()
            own[rng.integers(0, 300, c // 2)] = "changed"
            rows.append((100 * g + c, " ".join(own)))
    rows += [(9000, None), (8999, ""), (9001, "one two"), (9002, "ONE two"), (None, "one  two"), (None, "null id alone"), (50, rows[0][1]), (50, "other text of a repeated id"), (50, "other text of a repeated id")]
    return rows


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_near_fingerprints(spark, radius):
    rows = near_texts()
    docs = spark.createDataFrame([(i, "", "", 0, t, "t", "n", "u", "f") for i, t in rows], DOCS.replace("source string, lang string, n_chars bigint, text", "source string, label string, _label bigint, text"))
    fps = [brute_fingerprint(t) for _, t in rows]
    expected = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, brute_components(fps, [i for i, _ in rows], radius))]
    got = [tuple(r) for r in ballhash.near_duplicates(docs, radius).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_links_find_every_near_pair(spark):
    """Random fingerprints with planted neighbours at 1, 2 and 3 bits: what pairs connect is what brute force links."""
    rng = np.random.default_rng(11)
    fps = rng.integers(0, 2**63, 150, dtype=np.uint64)
    planted = [int(f) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for f in fps for k in (1, 2, 3)]
    every = sorted({int(f) for f in fps} | set(planted) | {0, 2**64 - 1, 3 << 62})
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    pairs = ballhash.links(spark.createDataFrame([(signed(f),) for f in every], "fp bigint"), 2).collect()
    place = {signed(f): i for i, f in enumerate(every)}
    near = [(i, j) for i, j in combinations(range(len(every)), 2) if (every[i] ^ every[j]).bit_count() <= 2]
    found = {tuple(sorted((place[r["a"]], place[r["b"]]))) for r in pairs}
    assert found <= set(near)
    group = lambda edges: brute_groups(len(every), edges)
    assert group(found) == group(near)
    with pytest.raises(ValueError):
        ballhash.links(spark.createDataFrame([(1,)], "fp bigint"), 3)


def brute_groups(n, edges):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def test_no_documents(spark):
    assert ballhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


VECTORS = "vec_id bigint, embedding array<float>, x binary, component int, n bigint"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], None, 1, 1) for i, v in rows], VECTORS)


def brute_whitening(rows, k=4):
    kept = [(i, [256 * float(np.float32(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(c)) for c in v] for _, v in kept])
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    centred = u - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    trace = (centred * centred).sum() / n
    return [i for i, _ in kept], n, deviation, (x - s / n) @ vectors / np.sqrt(values), values / trace


def test_whitening(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((700, 40)) * np.linspace(0.3, 0.05, 40) + rng.integers(0, 3, (700, 1)) * 0.2
    rows = list(enumerate(base.tolist()))
    rows += [(1000 + i, base[3].tolist()) for i in range(200)]
    rows += [(2000, None), (2001, [None, *base[0][1:]]), (2002, [float("nan"), *base[0][1:]]), (2003, [float("inf"), *base[0][1:]]), (2004, [0.0] * 40), (2005, [-0.0] * 40), (2004, [0.0] * 40), (None, base[5].tolist())]
    frame = vectors_frame(spark, rows)
    model = whitening.fit(frame)
    assert model.passes < 120
    out = whitening.whiten(frame, model).toPandas()
    ids, n, deviation, white, explained = brute_whitening(rows)
    assert len(out) == 4 * len(ids) and set(out["n"]) == {n}
    got = defaultdict(list)
    for r in out.itertuples():
        got[None if np.isnan(r.vec_id) else int(r.vec_id)].append((r.component, int(r.deviation), r.whitened, r.explained))
    signs = np.sign([sum(w * white[j, c] for j in range(20) for cc, _, w, _ in got[ids[j]] if cc == c + 1) for c in range(4)])
    for j, i in enumerate(ids):
        for component, d, w, e in got[i]:
            assert d == deviation[j] and abs(w - signs[component - 1] * white[j, component - 1]) < 1e-7 and abs(e / explained[component - 1] - 1) < 1e-9
    assert set(out["identity_error"]) == {model.identity_error} and model.identity_error < 1e-9


@pytest.mark.parametrize("spectrum", [np.full(64, 1.0), np.linspace(1.05, 0.95, 64), np.concatenate(([1e6, 9e5, 10, 9.9], np.linspace(1, 0.9, 60))), np.concatenate(([5, 3, 2], np.zeros(61)))])
def test_eigenpairs(spectrum):
    """Flat, crowded, steep and rank-deficient spectra."""
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    matrix = (turn * spectrum) @ turn.T
    values, vectors = whitening.eigenpairs(lambda q: matrix @ q, 64, 4, 12)
    assert np.allclose(values, np.sort(spectrum)[::-1][:4], atol=1e-11 * spectrum.max())
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-9 * spectrum.max()
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_whitening_odd_tables(spark):
    none = vectors_frame(spark, [(1, None), (2, [])])
    assert whitening.whiten(none, whitening.fit(none)).count() == 0
    empty = vectors_frame(spark, [])
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0
    one = vectors_frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])
    rows = whitening.whiten(one, whitening.fit(one)).collect()
    assert [(r["vec_id"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows] == [(1, 1, 0, None, None, None)] * 4
    huge = vectors_frame(spark, [(i, [3e38 * (-1) ** i, i, 1.0]) for i in range(9)] + [(50, [1.0])])
    rows = whitening.whiten(huge, whitening.fit(huge)).collect()
    assert len(rows) == 27 and {r["component"] for r in rows} == {1, 2, 3}
