"""Token counts, whitening and the filter audit against libraries and brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import audit, catalog, tokencount, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


# --- 11 token counts

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def told():
    return tokencount.read_tokenizer(PATH)


def lengths(library, texts):
    return [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_those_of_the_library(told, library):
    rng = random.Random(11)
    signs = "aaab  \n\t'sreld12!?é  \U0001F600İ<|>"
    texts = ["", " ", "a  b", "'s's 's ''s it'll've'd'm", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", "a\u0085b　 c"]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 60))) + rng.choice(["", "<|endoftext|>"]) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0x10000, 0x110000)])) for _ in range(80)) for _ in range(100)]
    texts += ["a" * k for k in (5, 64, 65, 130, 1000)] + ["ab" * 300 + "a" * 99, "-" * 300 + "=" * 40]
    texts += ["".join(rng.choices("abcdefghij", k=3000)), "".join(rng.choices("一丁日本", k=900))]
    assert tokencount.Counter(told).count(texts).tolist() == lengths(library, texts)


def test_long_texts_are_cut_where_it_does_not_matter(told, library, monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choices("abc  \n'1.", k=2000)) for _ in range(20)] + ["x" * 5000]
    monkeypatch.setattr(tokencount, "CHUNK", 50)
    monkeypatch.setattr(tokencount, "MEMO", 20)
    assert tokencount.Counter(told).count(texts).tolist() == lengths(library, texts)


def test_a_very_long_stretch_without_blanks(told, library):
    text = "".join(random.Random(13).choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    assert tokencount.Counter(told).count([text]).tolist() == lengths(library, [text])


def test_classes_cover_all_of_unicode(told, library):
    from tokenizers import pre_tokenizers
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    rng = random.Random(14)
    for c in rng.sample([*range(0xD800), *range(0xE000, 0x30000)], 5000):
        joins = [len(cut.pre_tokenize_str(s + chr(c))) == 1 for s in "a1!"]
        kind = [tokencount.LETTER, tokencount.NUMBER, tokencount.OTHER, tokencount.SPACE][joins.index(True) if any(joins) else 3]
        assert told["classes"][c] == kind, hex(c)


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):  # the merge of (4, 3) ranks above the one that makes 4
        tokencount.Merges(np.array([4, 1]), np.array([3, 2]), np.array([5, 4]), np.arange(4))


def test_count_query_and_edges(spark, smoke_dir, library):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in catalog.queries()["op11_token_counts"](spark, smoke_dir).collect()}
    want = dict(zip([r.doc_id for r in docs], lengths(library, [r.text or "" for r in docs])))
    assert {i: r.n_tokens for i, r in got.items()} == want
    assert all(got[r.doc_id].n_bytes == len((r.text or "").encode()) for r in docs)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got.values())
    tok = tokencount.shared_tokenizer(spark, PATH)
    rows = spark.createDataFrame([(None, None, 1, 2), (1, "", 3, 4), (1, "two words", 5, 6), (1, "two words", 5, 6)],
                                 "doc_id long, text string, N_Tokens int, count_text int")
    out = tokencount.count(rows, tok)
    assert out.columns == ["doc_id", "text", "count_text", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in out.collect()) == [(0, 0, 0), (1, 0, 0), (1, 9, 2), (1, 9, 2)]
    assert tokencount.count(rows.limit(0), tok).count() == 0


# --- 12 whitening

def spectrum(values, rng):
    n = len(values)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    return (q * np.asarray(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    [5.0], [2, 1], range(40), [3] * 12, [7] * 5 + [7 - 1e-12] * 5 + [1] * 6, [9, 4, 1] + [0] * 20, 10.0 ** -np.arange(20), [0] * 6,
    [1e12, 1, 1, 1, 0.5]])
def test_eigenvectors_by_divide_and_conquer(values):
    a = spectrum(list(values), np.random.default_rng(1))
    a = (a + a.T) / 2
    v = whitening.eigenvectors(a, 16)
    size = np.abs(a).max() or 1.0
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-13
    e = np.einsum("ij,ij->j", v, a @ v)
    assert np.abs(e - np.sort(np.linalg.eigvalsh(a))[::-1][:16]).max() < 1e-13 * size
    assert np.abs(a @ v - v * e).max() < 1e-13 * size


def test_polar_factor_is_the_sign():
    a = spectrum([4, 1, 1e-9, -1e-9, -3], np.random.default_rng(2))
    w, v = np.linalg.eigh((a + a.T) / 2)
    assert np.abs(whitening.polar_factor((a + a.T) / 2) - (v * np.sign(w)) @ v.T).max() < 1e-6


def brute_whitening(rows):
    """{(id, component): figures} of lists of (id, vector or None)."""
    sound = [(i, [int(np.floor(64 * float(c))) + 1000000 for c in v]) for i, v in rows
             if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in sound}))
    n, s = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T.astype(float), bias=True)
    w, v = np.linalg.eigh(cov)
    w, v = w[::-1], v[:, ::-1]
    out = {}
    for i, x in sound:
        dev = sum((n * a - int(b)) ** 2 for a, b in zip(x, s))
        z = (np.array(x) - s / n) @ v[:, :16] / np.sqrt(w[:16])
        out[i] = (n, dev, z, w[:16] / np.trace(cov))
    return out


def test_whitening_query_against_numpy(spark, smoke_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{smoke_dir}/embeddings.parquet").collect()]
    want = brute_whitening(rows)
    got = catalog.queries()["op12_embedding_whitening"](spark, smoke_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    table = got.orderBy("vec_id", "component").collect()
    assert len(table) == 16 * len(want) and len({r.identity_error for r in table}) == 1 and table[0].identity_error < 1e-10
    signs = {}
    for r in table:
        n, dev, z, explained = want[r.vec_id]
        k = r.component - 1
        assert (r.n, r.deviation) == (n, dev) and abs(r.explained - explained[k]) < 1e-10
        if abs(z[k]) > 1e-6:
            signs.setdefault(k, set()).add(np.sign(r.whitened) == np.sign(z[k]))
        assert abs(abs(r.whitened) - abs(z[k])) < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_edges(spark):
    rng = np.random.default_rng(5)
    base = [(i, [float(c) for c in rng.standard_normal(3)]) for i in range(30)]
    rows = base + [(100 + i, base[0][1]) for i in range(40)] + [(None, base[1][1]), (200, None), (201, []), (202, [1.0, None, 2.0]),
                                                                (203, [1.0, float("nan"), 2.0]), (204, [float("-inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(v, i, "x", 1) for i, v in rows], "embedding array<double>, vec_id long, x string, n int")
    out = whitening.whiten(df).collect()
    want = brute_whitening([r for r in rows if r[0] is not None and (r[1] is None or len(r[1]) == 3)])
    assert {r.vec_id for r in out} == {i for i in want} | {None} and len(out) == 3 * (len(want) + 1)
    assert all((r.n, int(r.deviation)) == want[r.vec_id][:2] for r in out if r.vec_id is not None)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id >= 100 AND vec_id < 200")).count() == 0  # one vector has no component
    assert whitening.whiten(df, id_col="x").columns[0] == "x"
    two = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [5.0]), (4, [6.0]), (5, [7.0])], "vec_id long, embedding array<float>")
    by = {}
    for r in whitening.whiten(two).collect():
        by.setdefault(r.vec_id, []).append(r)
    assert {i: (len(v), v[0].n) for i, v in by.items()} == {1: (1, 2), 2: (1, 2), 3: (1, 3), 4: (1, 3), 5: (1, 3)}


def test_deviations_beyond_a_long_are_exact():
    fit = whitening.Whitening(3, [0, 30], np.diag([4.0, 1.0]), 2)
    x = np.array([[1 << 40, 5], [-7, 10]])
    assert list(fit.deviations(x)) == [(3 << 40) ** 2 + 225, 441]


# --- 13 filter audit

def brute_audit(docs, labels):
    """{(part, order, step): figures} by applying every order to every document."""
    import re
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    facts = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        facts.append((part or "", {f for f, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in facts}:
        mine = [f for f in facts if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                                                   sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def figures(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def test_gray_walk_toggles_to_every_subset():
    cells = np.random.default_rng(3).integers(0, 9, (2, 3, 32))
    states = audit.gray_walk(cells)
    for subset in range(32):
        assert (states[..., subset] == cells[..., [m for m in range(32) if not m & subset]].sum(axis=-1)).all()


def test_audit_against_brute_force(spark):
    rng = random.Random(7)
    long = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", " \t\x0b\x0c\r\n", long, long, long, long.replace("w1", "W1"), "a " * 300, "A" * 50 + long, "x # y", long + " 5%",
             "one\x1ftwo " * 150, "É" * 300 + " Z" * 9, long + "|", "w" * 100_000]
    docs = [(rng.choice([None, *range(12)]), rng.choice(texts), rng.choice([None, "", "s1", "s2", "s3"])) for _ in range(200)]
    labels = [(rng.choice([None, *range(12)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(14)]
    df = spark.createDataFrame([(i, t, s, 1, "m") for i, t, s in docs], "doc_id long, text string, source string, part int, mask string")
    known = spark.createDataFrame([(*r, "g") for r in labels], "doc_id long, quality int, toxic int, good string")
    assert figures(audit.audit(df, known)) == brute_audit(docs, labels)
    assert audit.audit(df.limit(0), known).count() == 0
    assert figures(audit.audit(df, known.limit(0))) == brute_audit(docs, [])


def test_audit_query_has_all_rows(spark, smoke_dir):
    rows = catalog.queries()["op13_filter_audit"](spark, smoke_dir)
    parts = spark.read.parquet(f"{smoke_dir}/documents.parquet").select(F.coalesce("source", F.lit("")).alias("s")).distinct().count()
    assert rows.count() == parts * 600 == rows.select("part", "filter_order", "step").distinct().count()
