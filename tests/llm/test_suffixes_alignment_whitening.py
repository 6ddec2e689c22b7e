"""Suffix-array dedup, tokenizer alignment and whitening against brute force."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from lateline.llm import alignment, queries, suffixes, whitening

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x).hexdigest()


# -- op11 ------------------------------------------------------------------------------

def removed_by_force(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge[:len(b)]) > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])[:len(b)]).sum())
        out.append((len(b), int(gone.sum()), spans, sha(bytes(np.frombuffer(b, np.uint8)[~gone]))))
    return out


def op11(rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def test_op11_whole_table(spark):
    t = pq.read_table(f"{SF}/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), removed_by_force(t["text"].to_pylist()), strict=True))
    assert op11(queries.op11_suffix_dedup(spark, SF).collect()) == want and sum(v[1] for v in want.values()) > 0


@pytest.mark.parametrize(("block", "large"), [(1 << 19, 4096), (2000, 4096), (2000, 2)])
def test_op11_edges_periods_and_one_changed_byte(spark, monkeypatch, block, large):
    # passages around the length, at any offset; periodic texts; copies inside one text; few letters
    rng = np.random.default_rng(1)
    rnd = lambda n, letters=26: "".join(map(chr, 97 + rng.integers(0, letters, n)))
    passages = [rnd(k) for k in (399, 400, 401, 450, 900)]
    texts = [rnd(int(rng.integers(0, 300))) + passages[i % 5] + rnd(int(rng.integers(0, 300))) for i in range(60)]
    texts += ["a" * 3000, "a" * 399, "a" * 400, "a" * 401, "ab" * 700, "abc" * 300 + "x", "é" * 500, None, "", "x" * 10]
    texts += [texts[0], texts[0]] + [rnd(500, 2) for _ in range(10)]
    twice = rnd(600)
    texts += [twice + twice, twice[:450] + "Z" + twice[100:], twice[3:500]] + [p[:200] + "#" + p[201:] for p in passages]
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "BUCKET", 8)
    monkeypatch.setattr(suffixes, "STRINGS", 64)
    monkeypatch.setattr(suffixes, "LARGE", large)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert op11(suffixes.without_repeats(docs).collect()) == dict(enumerate(removed_by_force(texts)))


def test_op11_order_is_that_of_the_suffixes():
    rng = np.random.default_rng(3)
    strings = [rng.integers(1, 4, n).tolist() for n in (40, 7, 1, 25, 40)]
    at = [(s, i) for s, v in enumerate(strings) for i in range(len(v))]
    get = lambda s, i: strings[s][i] if i < len(strings[s]) else 0
    triple = {(s, i): tuple(get(s, i + k) for k in range(3)) for s, i in at}
    rank = {t: n + 1 for n, t in enumerate(sorted({triple[x] for x in at if x[1] % 3}))}
    name = lambda s, i: rank.get(triple.get((s, i)), 0)
    col = lambda f: np.array([f(s, i) for s, i in at])
    order = suffixes.merged_order(col(lambda s, i: i % 3), [col(name), col(lambda s, i: name(s, i + 3))],
                                  [col(get), col(lambda s, i: name(s, i + 1)), col(lambda s, i: name(s, i + 4))],
                                  [col(get), col(lambda s, i: get(s, i + 1)), col(lambda s, i: name(s, i + 2)), col(lambda s, i: name(s, i + 5))])
    first = [tuple(get(at[x][0], at[x][1] + k) for k in range(suffixes.PHRASES)) for x in order]
    assert sorted(order) == list(range(len(at))) and first == sorted(first)


def test_op11_odd_rows_and_kept_bytes(spark, odd_docs):
    texts = [r.text for r in odd_docs.collect()]
    rows = suffixes.without_repeats(odd_docs, texts=True).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == Counter((r.doc_id, *v) for r, v in zip(odd_docs.collect(), removed_by_force(texts), strict=True))
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in rows)
    empty = suffixes.without_repeats(odd_docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


# -- op12 ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    left = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    return left, shown, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def tokens_by_force(coders, text):
    left, shown, right = coders
    if not text:
        return []
    a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
    a = [(k, bytes(shown[c] for c in left.id_to_token(k))) for k in a]
    b = [(k, bytes([int(right.id_to_piece(k)[3:5], 16)]) if right.is_byte(k) else right.id_to_piece(k).replace("▁", " ").encode()) for k in b]
    want = (" " + text).encode()
    return [] if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want else [a, b]


def aligned_by_force(coders, texts):
    per, total = [], Counter()
    for t in texts:
        both = tokens_by_force(coders, t)
        if not both:
            per.append((0, 0, 0, "", []))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in both]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [defaultdict(list), defaultdict(list)]
        for side, e, g in zip(both, ends, groups, strict=True):
            for (k, _), x in zip(side, e, strict=True):
                g[bisect.bisect_left(cuts, x)].append(str(k))
        line = ";".join(",".join(groups[0][g]) + "|" + ",".join(groups[1][g]) for g in range(len(cuts)))
        links = [(a, b) for (a, x), p in zip(both[0], ends[0], strict=True) for (b, y), q in zip(both[1], ends[1], strict=True)
                 if max(p - len(x), q - len(y)) < min(p, q)] if len(both[0]) < 400 else None
        if links is None:  # long texts: walk both sides once
            links, j = [], 0
            for (a, x), p in zip(both[0], ends[0], strict=True):
                while j and ends[1][j - 1] > p - len(x):
                    j -= 1
                while ends[1][j] <= p - len(x):
                    j += 1
                i = j
                while i < len(both[1]) and ends[1][i] - len(both[1][i][1]) < p:
                    links.append((a, both[1][i][0]))
                    i += 1
        total.update(links)
        per.append((len(both[0]), len(both[1]), len(cuts), sha(line.encode()), links))
    best = defaultdict(int)
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return [(a, b, g, len(x), sum(total[k] == best[k[1]] for k in x), sum(total[k] for k in x), s) for a, b, g, s, x in per]


def op12(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def test_op12_whole_table(spark, coders):
    t = pq.read_table(f"{SF}/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), aligned_by_force(coders, t["text"].to_pylist()), strict=True))
    assert {r.doc_id: op12(r) for r in queries.op12_tokenizer_alignment(spark, SF).collect()} == want


def test_op12_rare_pairs_are_joined(spark, coders):
    t = pq.read_table(f"{SF}/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), aligned_by_force(coders, t["text"].to_pylist()), strict=True))
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    for most in (0, 300):
        assert {r.doc_id: op12(r) for r in alignment.aligned_documents(docs, frequent=most).collect()} == want


def test_op12_odd_rows(spark, coders, odd_docs):
    more = spark.createDataFrame([(20, "<|endoftext|><s></s> 日本語 \x00 é🙂"), (21, "low ▁ mark"), (22, " "), (23, "a" * 5000)], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    texts = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *v) for r, v in zip(texts, aligned_by_force(coders, [r.text for r in texts]), strict=True))
    assert Counter((r.doc_id, *op12(r)) for r in alignment.aligned_documents(docs).collect()) == want
    assert alignment.aligned_documents(docs.limit(0)).count() == 0


def test_op12_links_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "unbelievable tokenizers, naïvely aligned"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.links(docs).collect()}
    assert not got[2].overlaps and not got[2].share
    pair = alignment.pair_of(alignment.default_vocabulary(), alignment.default_pieces())
    a, b = np.cumsum(pair.a_size[got[1].a]), np.cumsum(pair.b_size[got[1].b])
    shared = {(i, j): min(p, q) - max(p - s, q - u) for i, (p, s) in enumerate(zip(a, pair.a_size[got[1].a], strict=True))
              for j, (q, u) in enumerate(zip(b, pair.b_size[got[1].b], strict=True))}
    assert {(r.a, r.b): r.bytes for r in got[1].overlaps} == {k: v for k, v in shared.items() if v > 0}
    cuts = sorted(set(a) & set(b))
    group = lambda x: bisect.bisect_left(cuts, x)
    assert {(r.a, r.b) for r in got[1].share} == {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if group(p) == group(q)}
    al = alignment.Aligned(pair, [np.array(got[1].a)], [np.array(got[1].b)])
    assert al.n_shared().tolist() == [len(got[1].share)]


def test_op12_products_are_those_of_dense_matrices():
    rng = np.random.default_rng(5)
    for limit in (1, 7, 1000):
        dense = [(rng.random((9, 8)) < 0.4) * rng.integers(1, 5, (9, 8)), (rng.random((8, 11)) < 0.4) * rng.integers(1, 5, (8, 11))]
        a, b = (alignment.Csr(np.concatenate([[0], np.cumsum((m > 0).sum(1))]), np.nonzero(m)[1], m.shape[1], m[m > 0]) for m in dense)
        out = np.zeros((9, 11), int)
        for i, j, v in alignment.product(a, b, limit):
            assert len(set(zip(i, j, strict=True))) == len(i)
            out[i, j] += v
        assert (out == dense[0] @ dense[1]).all()


# -- op13 ------------------------------------------------------------------------------

def check_whitened(rows, ids, vectors, wanted=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    m = min(wanted, int((e > 1e-9 * e[0]).sum()))
    assert len(rows) == n * m and {r.n for r in rows} == {n}
    got, at = np.zeros((n, m)), {v: i for i, v in enumerate(ids)}
    deviation = ((n * x - s) ** 2).sum(1)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    assert np.abs(got.T @ got / n - np.eye(m)).max() < 1e-8 and {r.identity_error < 1e-8 for r in rows} == {True}
    return got, centred @ u[:, :m] / np.sqrt(e[:m])


def test_op13_whole_table(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    got, want = check_whitened(queries.op13_embedding_whitening(spark, SF).collect(), t["vec_id"].to_pylist(), t["embedding"].to_pylist())
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-6 and (np.abs((got * want).sum(0)) > 0.999 * len(got)).all()


def test_op13_low_rank_and_equal_variances(spark):
    # four dimensions vary, two of them alike in every variance: the sequence breaks down and starts anew
    rng = np.random.default_rng(2)
    core = rng.integers(-50, 50, (40, 1)) * np.array([[1, 2, 0, 0, 3]]) / 64
    square = np.array([[1, 1], [1, -1], [-1, 1], [-1, -1]] * 10) / 16
    vectors = np.hstack([core, square, np.full((40, 3), 1e6)]).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    check_whitened(whitening.whitened_rows(df).collect(), range(40), vectors)


def test_op13_stops_early_where_the_wanted_components_are_exact():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 120)) * np.concatenate([[100, 50, 20], np.full(117, 0.01)])
    x -= x.mean(0)
    steps = []

    def product(v, p):
        steps.append(1)
        w = x @ v
        return x.T @ w, (x @ p).T @ w, w @ w

    sigma, right = whitening.bidiagonalise(product, 120, 3)
    true = np.linalg.svd(x, compute_uv=False)
    assert len(steps) < 60 and np.allclose(sigma[:3], true[:3], rtol=1e-12)
    assert np.allclose(x.T @ (x @ right[:, :3]), right[:, :3] * true[:3] ** 2, atol=1e-8)


def test_op13_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [rng.standard_normal(4).tolist() for _ in range(9)]
    rows = [(i, v, 7) for i, v in enumerate(good)]
    odd = [(50, None, 1), (51, [1.0, None, 2.0, 3.0], 1), (52, [1.0, float("nan"), 0.0, 0.0], 1), (53, [float("inf"), 0.0, 0.0, 0.0], 1)]
    schema = "vec_id long, embedding array<double>, component int"
    check_whitened(whitening.whitened_rows(spark.createDataFrame(rows + odd, schema)).collect(), range(9), good)
    # a short vector is filled with zeros, a repeated or null id is a row of its own
    short = spark.createDataFrame([*rows, (9, good[0][:2], 7), (None, good[1], 7), (3, good[3], 7)], schema)
    got = whitening.whitened_rows(short)
    assert got.groupBy("component").count().where("count = 12").count() == 4
    same = [r.whitened for r in got.where("vec_id = 3 and component = 1").collect()]
    assert len(same) == 2 and same[0] == same[1]
    assert whitening.whitened_rows(short.limit(0)).count() == 0
    assert whitening.whitened_rows(spark.createDataFrame(odd, schema)).count() == 0
    assert whitening.whitened_rows(spark.createDataFrame([(i, good[0], 1) for i in range(3)], schema)).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0], 1), (2, [-1e300, 1.0], 1), (3, [0.0, 2.0], 1)], schema)
    assert whitening.whitened_rows(huge).where("deviation is null").count() > 0
