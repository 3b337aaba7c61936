"""The pipeline against brute-force versions of its stages, on the smallest table."""

import random

import corpus_pipeline
from fleetlens.llm import bpe, catalog, simhash


def test_stages_keep_the_columns_and_take_effect(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "encode"]
    now = docs
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in now.collect()}
        now = corpus_pipeline.staged(stage(spark, now, smoke_dir), "test")
        assert now.columns == docs.columns
        after = {r.doc_id: r.text for r in now.collect()}
        sizes.append(len(after))
        if name == "line_dedup":
            assert set(after) == set(before)
            assert all(len(after[i]) <= len(before[i]) for i in after)
        elif name == "near_dedup":
            prints = {i: simhash.fingerprint(t or "") for i, t in before.items()}
            kept = [prints[i] for i in after]
            assert all(bin(a ^ b).count("1") > 2 for k, a in enumerate(kept) for b in kept[:k])
            assert {prints[i] for i in before if i not in after} <= {v for v in prints.values() if any(bin(v ^ k).count("1") <= 2 for k in kept)}
        elif name == "decontamination":
            assert not any(b in (t or "") for t in after.values() for b in items)
            assert all(any(b in (before[i] or "") for b in items) for i in before if i not in after)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    codec = bpe.Codec.from_file(catalog.byte_bpe_ranks())
    rows = corpus_pipeline.STAGES[-1][1](spark, now, smoke_dir).collect()
    assert len(rows) == sizes[-1]
    for r in rows:
        ids, _ = codec.encode([r.text or ""])
        assert list(r.token_ids) == ids.tolist() and r.n_tokens == len(ids)
    assert {r.doc_id for r in corpus_pipeline.run(spark, smoke_dir).collect()} == {r.doc_id for r in rows}


def test_stages_of_an_empty_table(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, smoke_dir).count() == 0


def test_stages_take_nulls_ties_repeats_and_clashing_columns(spark, smoke_dir):
    """Each stage on its own: no row with odd values stops it, clean texts stay, columns stay as they are."""
    rng = random.Random(17)
    story = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(80)).capitalize() + "." for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(story)] + [(0, story[0]), (0, story[0]), (50, story[0]), (None, story[1]), (None, None), (None, None),
                                                    (7, None), (8, ""), (8, ""), (9, "word " * 200_000), (10, story[2] + " " + story[3])]
    names = "doc_id long, text string, lang string, source string, n_chars long, simhash long, text_hash string, gone int, c0 string, tail_probability string"
    docs = spark.createDataFrame([(i, t, None, None, None, 1, "a", 2, "b", "c") for i, t in rows], names)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (plain, docs):
            out = stage(spark, table, smoke_dir)
            assert out.columns == table.columns, name
            got = [(r.doc_id, r.text) for r in out.collect()]
            if name == "line_dedup":
                assert len(got) == len(rows)
                left = dict((i, t) for i, t in got if i is not None and i < 6)
                assert left == dict(enumerate(story)) and (50, "") in got and (10, "") in [(i, (t or "").strip()) for i, t in got]
            elif name == "near_dedup":
                kept = [t for _, t in got]
                assert set(story) <= set(kept) and len([t for t in kept if not t]) == 1 and kept.count(story[0]) == 1
                assert (0, story[0]) in got and (1, story[1]) in got
            elif name == "decontamination":
                assert len(got) == len(rows)
    codes = corpus_pipeline.STAGES[-1][1](spark, docs, smoke_dir)
    assert codes.count() == len(rows) and codes.where("text IS NULL AND n_tokens > 0").count() == 0
    assert codes.columns == [*docs.columns, "token_ids", "n_tokens"]
