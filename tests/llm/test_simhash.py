import random
import re

import duckdb
import pytest
import xxhash

from claimloom.llm import components, simhash

FIELDS = "doc_id bigint, text string, fingerprint int, fp string"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """{value: smallest value reachable} over links of two bits or fewer."""
    left, out = set(values), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a = todo.pop()
            group.add(a)
            near = {b for b in left if (a ^ b).bit_count() <= 2}
            left -= near
            todo += near
        out |= dict.fromkeys(group, frozenset(group))
    return out


@pytest.mark.parametrize("longest", [1, 3, 64])
def test_links_against_all_pairs(spark, longest):
    random.seed(longest)
    values = set()
    for _ in range(12):
        at = random.getrandbits(64)
        for _ in range(25):
            values.add(at)
            for _ in range(random.choice([1, 1, 2, 3])):
                at ^= 1 << random.randrange(64 if random.random() < 0.3 else 20)
    values |= {0, 1, 2**64 - 1, 2**63}
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "fp bigint")
    links = [(a % 2**64, b % 2**64) for a, b in simhash.links(frame, longest).collect()]
    assert all(0 < (a ^ b).bit_count() <= 2 for a, b in links)
    roots = {n % 2**64: r % 2**64 for n, r in components.connected_components(simhash.links(frame, longest)).collect()}
    assert len(roots) == len(set(roots))
    for v, group in plain_components(values).items():
        assert {w for w in values if roots.get(w, w) == roots.get(v, v)} == group


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000)]
    roots = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert roots == {i: 0 for i in range(301)} | {1000 + k: 1000 for k in range(400)}


def test_defined_cases(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta"
    texts = [None, "", " \n", "one", "One", "one two", base, base.upper(), "É é x y", "z " * 30_000, base + " iota"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(6, base, 1, "x"), (None, base, 1, "x"), (None, "alone", 1, "x"), (None, "alone", 1, "x")]
    docs = spark.createDataFrame(rows, FIELDS)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    values = {plain_fingerprint(t) for _, t, *_ in rows}
    groups = plain_components(values)
    ids = {}
    for i, t, *_ in rows:
        if i is not None:
            for v in groups[plain_fingerprint(t)]:
                ids[v] = min(i, ids.get(v, i))
    expected = sorted((str(i), f"{(v := plain_fingerprint(t)):016x}", str(ids.get(v))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected
    stay = sorted(str(r.doc_id) for r in simhash.one_of_each(docs).collect())
    assert stay == sorted([*{str(v) for v in ids.values()}, "None"])
    assert simhash.one_of_each(docs).columns == docs.columns


def test_driver_rows_against_all_pairs(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs}
    groups = plain_components(set(prints.values()))
    for i, v in prints.items():
        assert found[i] == (f"{v:016x}", min(j for j, w in prints.items() if w in groups[v]))


def test_tally_tells_six_shared_bytes():
    assert len(simhash.CHOICES) == 14
    for places in range(256):
        shared = {k for k in range(8) if places >> k & 1}
        tally = sum(set(c) <= shared for c in simhash.CHOICES)
        assert (tally >= simhash.LEAST_SHARED) == (len(shared) >= 6)


def test_one_of_each_judges_rows_under_one_id_apart(spark):
    texts = ["alpha beta gamma delta", "one two three four five", "six seven eight nine ten"]
    rows = [(5, texts[0], 1), (5, texts[1], 2), (5, texts[1], 2), (5, texts[1], 3), (9, texts[0].upper(), 4), (3, texts[2], 5), (5, texts[2], 6), (None, texts[2], 7), (None, "only here now", 8), (None, "Only here now", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(4)
    found = [simhash.one_of_each(docs).collect() for _ in range(2)]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1]))
    stay = sorted((r.doc_id or 99, r.text.lower()) for r in found[0])
    assert stay == sorted([(5, texts[0]), (5, texts[1]), (3, texts[2]), (99, "only here now")])


def test_near_copies_are_judged_as_they_came(spark):
    base = [f"w{k}" for k in range(400)]
    whole = simhash.fingerprint(" ".join(base).encode())
    copies = ([*base[:k], "other", *base[k + 1 :]] for k in range(400))
    edited = next(c for c in copies if (whole ^ simhash.fingerprint(" ".join(c).encode())).bit_count() <= 2)
    came = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(edited)), (3, "a clean text"), (4, "x y z"), (4, "q r s"), (None, "n")], "doc_id bigint, text string")
    left = spark.createDataFrame([(1, " ".join(base), "a"), (2, "other", "b"), (3, "a clean text", "c"), (4, "x y z", "d"), (8, "other", "e"), (None, None, "f")], "doc_id bigint, text string, doc string")
    out = simhash.without_later_copies(left, came)
    assert out.columns == left.columns
    assert sorted(r.doc for r in out.collect()) == list("acdef")
    assert simhash.without_later_copies(left.limit(0), came).collect() == []


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.one_of_each(docs).collect() == []


def test_nothing_that_grows_is_broadcast(spark):
    """Links, steps of components and the results: a small file may be many rows once its postings are exploded."""
    docs = spark.createDataFrame([(k, f"a few words {k} of text {k % 7}") for k in range(50)], "doc_id bigint, text string")
    frame = spark.createDataFrame([(k * 7919,) for k in range(50)], "fp bigint")
    links = frame.select(frame.fp.alias("a"), (frame.fp + 1).alias("b"))
    frames = [simhash.links(frame), components._small_star(components._large_star(links)), simhash.near_duplicates(docs), simhash.one_of_each(docs), simhash.without_later_copies(docs, docs)]
    for made in frames:
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan
