import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quantloom.llm import near_dedup as near_module
from quantloom.llm.components import components
from quantloom.llm.embedding_dedup import hadamard, near_vectors, polytope_codes
from quantloom.llm.exact_dedup import exact_dedup
from quantloom.llm.near_dedup import _FIRST, near_dedup, nibbles, permute, signatures
from quantloom.llm.shingles import Shingler
from quantloom.llm.tables import Workspace

from . import cases


def test_exact_agrees_with_brute_force(spark):
    rows = cases.awkward_rows()
    cases.same(exact_dedup(cases.table(spark, rows)), cases.exact(rows))


def test_exact_compares_bytes_where_hashes_and_digests_collide(spark):
    rows = cases.awkward_rows()
    weak = exact_dedup(cases.table(spark, rows), lambda c: F.lit(b"same"), lambda c: F.length(c) % 2)
    cases.same(weak, cases.exact(rows))


def test_empty_tables(spark):
    assert exact_dedup(cases.empty(spark)).collect() == []
    assert near_dedup(cases.empty(spark)).collect() == []
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_agrees_with_brute_force(spark, width, percent):
    rows = cases.awkward_rows()
    found = near_dedup(cases.table(spark, rows), width=width, percent=percent, bands=32, rows=5)
    cases.same(found, cases.near(rows, width, percent))


@pytest.mark.parametrize("wide", [1, 64])
def test_near_finds_chains_and_large_groups(spark, wide):
    """Each text changes one word of the one before: neighbours are linked, ends are not."""
    words = cases.prose(7, 120).split()
    rows = []
    for i in range(60):
        words[2 * i % 120] = f"new{i}"
        rows.append((i, " ".join(words)))
    cases.same(near_dedup(cases.table(spark, rows), width=3, percent=85, bands=20, rows=5, stars=1, wide=wide), cases.near(rows, 3, 85))


def test_near_meets_look_alikes_by_their_rare_shingles(spark, monkeypatch):
    """300 pages of one template with words of their own: large buckets, no main component, a link only between 298 and 299."""
    pairs = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def compared(_):
        pairs.add(1)
        return 0

    monkeypatch.setattr(near_module, "_differing", lambda a, b, width: compared(a[0].bitwiseXOR(b[0])))
    words, rows = cases.prose(9, 100).split(), []
    for i in range(299):
        own = {(7 * i + 20 * k) % 100: f"own{i}x{k}" for k in range(5)}
        rows.append((i, " ".join(own.get(at, word) for at, word in enumerate(words))))
    rows.append((299, rows[298][1] + " end"))
    cases.same(near_dedup(cases.table(spark, rows), width=3, percent=85, bands=20, rows=5, wide=8), cases.near(rows, 3, 85))
    assert 0 < pairs.value < 100 * len(rows)


@pytest.mark.parametrize("percent", [30, 70, 85, 100])
def test_rare_shingles_find_every_similar_pair(spark, percent):
    """Chains of changes, parts of texts and short texts, against plain set comparison; an id has two rows."""
    words, rows = cases.prose(10, 90).split(), []
    for i in range(30):
        words[3 * i % 90] = f"new{i}"
        rows.append((i, " ".join(words[:90 - 2 * (i % 7)])))
        rows.append((100 + i, " ".join(words[:i % 8 + 1])))
    rows.append((5, " ".join(reversed(words))))
    ids = sorted({i for i, _ in rows})
    crowd = spark.createDataFrame([(i, i // 3, i % 2 == 0) for i in ids], "node long, comp long, asks boolean")
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_module._rare_pairs(Workspace(spark, "test"), crowd, texts, 3, percent).collect()
    sets = [(i, cases.shingle_set(t, 3)) for i, t in rows]
    want = {(a, b, b // 3) for a, x in sets for b, y in sets if a % 2 == 0 and a // 3 != b // 3 and 100 * len(x & y) >= percent * len(x | y)}
    assert want and want <= {tuple(r) for r in found} and len(found) == len(set(found))


def test_blocks_meet_every_member_of_their_component(spark, monkeypatch):
    """Three askers and a component of seven, in blocks of two, against plain set comparison."""
    monkeypatch.setattr(near_module, "BLOCK", 2)
    words = cases.prose(8, 100).split()
    rows = [(i, " ".join([*words[:3 * i], *(f"x{i}{k}" for k in range(8)), *words[3 * i + 8:]])) for i in range(10)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    attached = spark.createDataFrame([(i, 0) for i in (7, 8, 9)], "node long, comp long")
    everyone = spark.createDataFrame([(i, 0) for i in range(7)], "node long, comp long")
    found = near_module._blockwise(Workspace(spark, "test"), attached, everyone, texts, 3, 70)
    sets = {i: cases.shingle_set(t, 3) for i, t in rows}
    want = [(b, a) for a in (7, 8, 9) for b in range(7) if 100 * len(sets[a] & sets[b]) >= 70 * len(sets[a] | sets[b])]
    assert want
    cases.same(found.select("a", "b"), want)


def test_shingles_are_sets_of_word_sequences():
    values, sizes = Shingler(3).flat(pa.array(["A b C", "a B c", "a b c a b c", "a b", None, " "]))
    assert sizes.tolist() == [1, 1, 3, 1, 0, 0]
    assert values[0] == values[1] and values[0] in values[2:5]


def test_permutation_is_a_bijection_and_signatures_follow_the_definition():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(permute(x, _FIRST, np.empty_like(x), np.empty_like(x)))) == len(x)
    values, sizes = Shingler(2).flat(pa.array([cases.prose(1, 50), cases.prose(2, 700), "x"]))
    whole, cut = signatures(values, sizes, 40), signatures(values, sizes, 40, chunk=64)
    assert (whole == cut).all()
    assert (nibbles(whole)[:, 0] & 15 == whole[:, 0] & 15).all()


def test_signature_agreement_estimates_similarity():
    a, b = cases.prose(3, 2000).split(), cases.prose(4, 2000).split()
    mixed = a[:1500] + b[:500]
    values, sizes = Shingler(3).flat(pa.array([" ".join(a), " ".join(mixed)]))
    s = signatures(values, sizes, 400)
    left, right = set(values[:sizes[0]].tolist()), set(values[sizes[0]:].tolist())
    assert abs((s[0] == s[1]).mean() - len(left & right) / len(left | right)) < 0.1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_agree_with_union_find(spark, links):
    edges = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(Workspace(spark, "test"), edges).collect()}
    linked = [(a, b) for a, b in links if a != b]
    assert found == cases.roots({x for e in linked for x in e}, linked)


def brute_vectors(rows, threshold):
    good = {}
    for at, (i, v) in enumerate(rows):
        x = np.array([np.nan if c is None else c for c in v], np.float32).astype(float) if v else np.array([np.nan])
        if np.isfinite(x).all() and (x * x).sum() > 0:
            good[at] = x
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= threshold]
    root = cases.roots({i for i, _ in rows}, [(rows[a][0], rows[b][0]) for a, b in links])
    count = {at: sum(at in e for e in links) for at in range(len(rows))}
    return [(i, count[at], root[i], root[i] == i) for at, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block,group_rows", [(1024, 4096), (8, 64)])
def test_vectors_agree_with_brute_force(spark, block, group_rows):
    """A hot bucket (60 near copies, split into blocks in one case), copies, scaled copies, ties and unusable vectors."""
    rng = np.random.default_rng(0)
    centre = rng.normal(size=24)
    rows = [(i, (centre + 0.08 * rng.normal(size=24)).tolist()) for i in range(60)]
    rows += [(100 + i, rng.normal(size=24).tolist()) for i in range(60)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, [2 * c for c in rows[70][1]]), (203, None), (204, [0.0] * 24), (205, []),
             (206, [1.0, None] + [0.0] * 22), (207, [float("nan")] * 24), (208, [1.0, 2.0, 3.0]), (209, [1.0, 2.0, 3.0]), (210, [float("inf")] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash")).repartition(3)
    cases.same(near_vectors(df, block=block, group_rows=group_rows), brute_vectors(rows, 0.95))


def test_vector_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(300, 64))
    noise = rng.normal(size=(300, 64))
    noise -= (noise * a).sum(1, keepdims=True) / (a * a).sum(1, keepdims=True) * a
    noise *= np.linalg.norm(a, axis=1, keepdims=True) / np.linalg.norm(noise, axis=1, keepdims=True)
    b = 0.952 * a + np.sqrt(1 - 0.952**2) * noise
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.agg(F.sum("n_links")).first()[0] >= 0.99 * 600


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(2).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x) / 4, axis=1), np.linalg.norm(x, axis=1))
    assert polytope_codes(x, 0, 4).shape == (5, 4)
