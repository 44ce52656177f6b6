import corpus_pipeline
from claimloom.llm import decontamination, packing, quality_cnn, simhash
from test_decontamination import plain_nearest
from test_line_dedup import plain
from test_quality_cnn import plain_score
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def least_of_groups(prints):
    """Of {id: fingerprint}, the least id of each component."""
    groups = plain_components(set(prints.values()))
    return {min(j for j, w in prints.items() if w in groups[v]) for v in prints.values()}


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "quality" in names[0] and "pack" in names[-1]
    came = {r.doc_id: r for r in docs.collect()}

    net = quality_cnn.fit(docs, labels)
    good = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    rows = {r.doc_id: r for r in good.collect()}
    scores = {i: plain_score(net, (r.text or "").encode()) for i, r in came.items()}
    assert all(abs(s - 0.3) > 1e-4 for s in scores.values())
    assert sorted(rows) == sorted(i for i, s in scores.items() if s >= 0.3) and 0 < len(rows) < len(came)
    assert all(rows[i] == came[i] for i in rows)

    less = corpus_pipeline.STAGES[1][1](spark, good, SF)
    expected = plain([(i, rows[i].text) for i in sorted(rows)])
    rows = {r.doc_id: r for r in less.collect()}
    # A document that came without a word stays as it was; one that lost them all goes.
    gone = {i for i, words in expected.items() if not words and (came[i].text or "").split()}
    assert less.columns == columns and sorted(rows) == sorted(set(expected) - gone)
    for i, r in rows.items():
        assert (r.text or "").split() == expected[i] and r.n_chars == len(r.text or "")
        assert r[2:4] == came[i][2:4]
    assert any(len(expected[i]) < len((came[i].text or "").split()) for i in rows)

    single = corpus_pipeline.STAGES[2][1](spark, less, SF)
    first = least_of_groups({i: plain_fingerprint(came[i].text) for i in rows})
    stay = least_of_groups({i: plain_fingerprint(rows[i].text) for i in first})
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(stay)

    clean = corpus_pipeline.STAGES[3][1](spark, single, SF)
    items = [decontamination.words_of((r.text or "").encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and kept <= stay
    for i in sorted(stay):
        words = decontamination.words_of((rows[i].text or "").encode())
        hit = len(words) < 3000 and any(len(set(x) & set(words)) >= 0.8 * len(set(x)) - 1 and plain_nearest(x, words)[0] <= decontamination.allowed(len(x)) for x in items if x)
        assert hit == (i not in kept) or len(words) >= 3000

    packed = corpus_pipeline.STAGES[4][1](spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == kept
    assert all(0 < r.length and r.offset + r.length <= packing.CONTEXT for r in packed)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 50 and "sequence_id" in found.columns


def test_stages_take_empty_and_odd_tables(spark):
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id int, words string"
    long = " ".join(f"word{k}" for k in range(9000))
    rows = [(1001, None, None, None, None, 1, "a"), (1001, None, None, None, None, 1, "a"), (None, "", "x", "y", 0, 2, "b"), (1002, long, "x", "y", len(long), 3, "c"), (1003, long, None, "y", len(long), 4, "d")]
    odd = spark.createDataFrame(rows, fields)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), SF).collect() == []
        assert stage(spark, odd, SF).columns == odd.columns
    text = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    nulls, empty, one, two = ("1001", None), ("None", ""), ("1002", long), ("1003", long)
    net = quality_cnn.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(net.score([b"", long.encode()]) >= 0.3) <= {True, False}
    less = corpus_pipeline.STAGES[1][1](spark, odd, SF)
    assert text(less) == sorted([nulls, nulls, empty, one], key=str)
    single = corpus_pipeline.STAGES[2][1](spark, odd, SF)
    assert text(single) == sorted([nulls, one], key=str)
    assert text(corpus_pipeline.STAGES[3][1](spark, odd, SF)) == sorted([nulls, nulls, empty, one, two], key=str)
    packed = corpus_pipeline.STAGES[-1][1](spark, odd, SF)
    assert sorted({str(r.doc_id) for r in packed.collect()}) == ["1001", "1002", "1003", "None"]
