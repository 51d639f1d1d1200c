"""Quality rules, fingerprints, SimHash and line dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keylane.llm import fingerprints, line_dedup, quality, simhash
from keylane.llm.components import components
from keylane.llm.texts import Texts, Words, blocks
from keylane.session import stored
from tests.llm.conftest import LOWER, ODD, words

ANY_TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b#é汉  .", max_size=60)), max_size=6)


def array(values):
    return pa.array(values, pa.string())


def base(text):
    found = words(text)
    windows = Counter(tuple(found[i: i + 3]) for i in range(len(found) - 2))
    marked = {j for i in range(len(found) - 2) if windows[tuple(found[i: i + 3])] > 1 for j in range(i, i + 3)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), copies, len(marked))


@settings(max_examples=150, deadline=None)
@given(ANY_TEXTS)
def test_measures_match_brute_force(values):
    found = quality.measure(Texts(array(values)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(found[n][i]) for n in names) for i in range(len(values))] == [base(v) for v in values]


@settings(max_examples=100, deadline=None)
@given(ANY_TEXTS)
def test_words_and_hashes_do_not_depend_on_the_block(values):
    texts = Texts(array(values))
    found = Words(texts)
    got = [texts.data[s:e].tobytes().decode() for s, e in zip(found.start, found.end, strict=True)]
    assert got == [w for v in values for w in words(v)]
    alone = [int(Words(t).hashes()[0]) for w in got for t in [Texts(array([w]))]]
    assert found.hashes().tolist() == alone


def test_sliced_batches_and_blocks():
    batch = pa.RecordBatch.from_arrays([array(["x y", None, "z" * 5_000_000, "", "q r s"])], ["text"])
    parts = list(blocks(batch.slice(1), "text"))
    assert sum(p.num_rows for p in parts) == 4
    assert [int(n) for p in parts for n in Words(Texts(p.column(0))).per_text] == [0, 1, 0, 3]


def test_quality_query(spark, sf_dir, texts):
    rows = quality.op4_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *rest)
        assert r["base_failed"] == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (r["base_failed"] and r["kept"])


def test_quality_keeps_clean_and_drops_repetition(spark):
    clean = " ".join(f"word{i}" for i in range(200))
    phrase = "the very same ten words come over and over again "
    rows = [(1, clean), (2, phrase * 4 + " ".join(f"w{i}" for i in range(50))), (3, "\n".join(["a line that is repeated"] * 3) + " " + clean)]
    kept = {r["doc_id"] for r in quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1, 3}


def test_quality_odd_rows(odd, empty, wide):
    assert quality.repetition(odd, ["doc_id"]).count() == len(ODD)
    assert quality.keep_good(empty).count() == 0
    assert quality.keep_good(wide).columns == wide.columns


def jaccard(a, b):
    return len(a & b) / len(a | b)


def shingles(text, n=5):
    found = words(text)
    return {tuple(found[i: i + n]) for i in range(max(1, len(found) - n + 1))}


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(5000)]
    first = [vocabulary[i] for i in rng.integers(0, 5000, 1000)]
    for part in (0, 100, 400, 1000):
        second = [vocabulary[i] for i in rng.integers(0, 5000, part)] + first[part:]
        a, b = " ".join(first), " ".join(second)
        sig = fingerprints.signatures(Texts(array([a, "", b, b])))
        assert abs(fingerprints.likeness(sig[:1], sig[2:3])[0] - jaccard(shingles(a), shingles(b))) < 0.15
        assert (sig[2] == sig[3]).all()


def test_signatures_do_not_depend_on_the_block():
    values = ["a b c d e f g", "", "x", None, "a b", "a b c d e f g", " ".join(map(str, range(40_000)))]
    together = fingerprints.signatures(Texts(array(values)))
    for value, row in zip(values, together, strict=True):
        assert (fingerprints.signatures(Texts(array([value])))[0] == row).all()
    assert (together[1] == together[3]).all()


def edited(ordered):
    """(n_chars, sha256 of the edited text) per row in order of id."""
    out = []
    for i, text in enumerate(ordered):
        half = len(text) // 2
        value = text[: len(text) - half] + ordered[(i + 1) % len(ordered)][:half]
        out.append((len(text), hashlib.sha256(value.encode()).hexdigest()))
    return out


def test_fingerprint_query(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in fingerprints.op2_document_fingerprints(spark, sf_dir).collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    expected = edited([texts[i] or "" for i in ids])
    assert [(rows[i]["n_chars"], rows[i]["edited_sha256"]) for i in ids] == expected
    by_text = defaultdict(set)
    for i in ids:
        by_text[texts[i]].add(rows[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    plain = [plain_signature(texts[i] or "") for i in ids]
    for n, i in enumerate(ids):
        following = (n + 1) % len(ids)
        changed = plain_signature(fingerprints.edited_text(texts[i] or "", texts[ids[following]] or ""))
        assert (rows[i]["fingerprint"], rows[i]["edited_fingerprint"]) == tuple("".join(f"{v:04x}" for v in x) for x in (plain[n], changed))
        assert rows[i]["near_edited"] == np.mean(plain[n] == changed) and rows[i]["near_next"] == np.mean(plain[n] == plain[following])


def plain_signature(text):
    """The least value of every permutation over one text's shingles, each of which has a hash of its own."""
    hashes, _ = fingerprints.shingle_hashes(Texts(pa.array([text])))
    assert len(set(hashes.tolist())) == max(len(shingles(text)), 1)
    return np.array([(hashes * a + b).min() >> np.uint64(48) for a, b in zip(fingerprints._A, fingerprints._B, strict=True)])


@pytest.mark.parametrize("quantiles", [[], [5], [3, 3, 9], [-(2**63)] * 5 + [0, 7, 7, 7], [1, 2, 3]])
def test_cuts_count_what_is_not_above(quantiles):
    cuts = fingerprints.Cuts(np.array(quantiles, np.int64))
    pairs = [(v, j * 2**64 // quantiles.count(v) - 2**63) for v in sorted(set(quantiles)) for j in range(quantiles.count(v))]
    values = np.random.default_rng(4)
    k = values.choice(np.array([-(2**63), -1, 0, 1, 2, 3, 4, 5, 7, 8, 9, 10], np.int64), 500)
    h = np.append(values.integers(-(2**63), 2**63 - 1, 498), [-(2**63), 2**63 - 1])
    assert cuts.number(k, h).tolist() == [sum(p <= row for p in pairs) for row in zip(k.tolist(), h.tolist())]


@pytest.mark.parametrize("most", [3, 10_000])
def test_missing_ids_are_cut_and_slices_bounded(spark, monkeypatch, most):
    """Two thirds of the rows have no id; slices change no row."""
    monkeypatch.setattr(fingerprints, "MOST_SLICES", most)
    table = [(None if i % 3 else i, f"text {i} of some more words than five {i * i}") for i in range(300)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    own = fingerprints.in_slices(docs, rows_each=10).filter("not borrowed").groupBy("slice").count().collect()
    assert sum(r["count"] for r in own) == 300 and len(own) <= most
    assert most == 3 or max(r["count"] for r in own) < 40
    whole = sorted(map(tuple, fingerprints.fingerprints(docs).collect()), key=repr)
    monkeypatch.setattr(fingerprints.in_slices, "__defaults__", (10,))
    assert sorted(map(tuple, fingerprints.fingerprints(docs).collect()), key=repr) == whole


def test_fingerprints_over_many_slices(spark, docs, texts):
    sliced = fingerprints.in_slices(docs, rows_each=7)
    own = sliced.filter("not borrowed")
    assert own.count() == len(texts)
    assert own.groupBy("slice").count().agg(F.max("count")).first()[0] < 60
    ranges = own.groupBy("slice").agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("slice").collect()
    lent = {r["slice"]: r["k"] for r in sliced.filter("borrowed").collect()}
    for one, two in zip(ranges, [*ranges[1:], ranges[0]], strict=True):
        assert lent[one["slice"]] == two["low"]


def test_fingerprints_odd_rows(odd, empty, wide):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    assert fingerprints.fingerprints(wide).count() == len(ODD)
    assert fingerprints.fingerprints(empty).count() == 0


def test_near_duplicate_classes(spark, docs, texts):
    ids = sorted(texts)
    held = [shingles(texts[i]) for i in ids]
    parent = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if jaccard(held[i], held[j]) >= 0.8 and parent[i] != parent[j]:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    for tile in (2, 256):
        got = {r["doc_id"]: r["class_id"] for r in fingerprints.near_duplicates(docs, tile=tile).collect()}
        assert [got[i] for i in ids] == [ids[p] for p in parent]
    assert len(set(parent)) < len(ids)


def test_near_duplicate_classes_of_odd_rows(odd, empty, wide):
    rows = fingerprints.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, -7)} >= {-7}
    assert fingerprints.near_duplicates(wide).count() == len(ODD)
    assert fingerprints.near_duplicates(empty).count() == 0


def test_one_document_follows_itself(spark):
    row = fingerprints.fingerprints(spark.createDataFrame([(4, "abcde")], "doc_id long, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcab").hexdigest()
    assert row["near_next"] == 1.0


def simhash64(text, n=3):
    found = words((text or "").translate(LOWER))
    held = [" ".join(found[i: i + n]) for i in range(max(1, len(found) - n + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in held]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def linked(values, radius, also=lambda x: True):
    """Least index reachable over links, for each index."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and also(values[i] ^ values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_simhash_query(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in simhash.op5_simhash_near_dedup(spark, sf_dir).collect()}
    ids = sorted(texts)
    prints = [simhash64(texts[i]) for i in ids]
    assert [rows[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [rows[i]["component_id"] for i in ids] == [ids[r] for r in linked(prints, 3)]


def test_simhash_tiles_lose_no_link(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for c in centres for k in (0, 1, 2, 3, 4, 5) for _ in range(4)}
    values = sorted({v - 2**64 if v >= 2**63 else v for v in values})
    frame = spark.createDataFrame([(v, [v]) for v in values], "node long, fp array<long>")
    for tile in (8, 16_384):
        found = {r["node"]: r["root"] for r in components(simhash.links(frame, tile=tile)).collect()}
        expected = linked([v % 2**64 for v in values], 3)
        assert [found.get(v, v) for v in values] == [values[r] for r in expected]


def test_wide_fingerprints_lose_no_link_wherever_their_bits_differ():
    rng = np.random.default_rng(6)
    for bits in (23, 50, 51):
        for places in (np.arange(64), np.arange(64, 256), np.arange(256)):
            a = rng.integers(0, 2**63, (40, 4), dtype=np.uint64)
            b = a.copy()
            for row in b:
                for at in rng.choice(places, bits, replace=False).tolist():
                    row[at // 64] ^= np.uint64(1 << at % 64)
            moved, root = simhash._forest(a, b, simhash.ALIKE)
            assert (moved.tolist(), root.tolist()) == ((list(range(40, 80)), list(range(40))) if bits <= 50 else ([], []))


def test_alike_texts_are_linked_and_others_are_not(spark):
    rng = np.random.default_rng(7)
    rows, base_words = [], [[f"t{x}" for x in rng.integers(0, 900, 300)] for _ in range(20)]
    for i, own in enumerate(base_words):
        near = list(own)
        for at in rng.choice(300, 5, replace=False):
            near[at] = "changed"
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(near))]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(0, 40, 2))


def exactly_alike(rows):
    """Ids that stay of (id, text): the least of each component of pairs alike by 0.8, A-Z lowered."""
    rows = sorted(rows)
    sets = [shingles((t or "").translate(LOWER)) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and jaccard(sets[i], sets[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [rows[i][0] for i in sorted(set(root))]


def test_one_of_each_decides_by_exact_similarity(spark):
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(12):
        own = [f"t{x}" for x in rng.integers(0, 10**6, 200)]
        for low in (0, 1, 20, 21, 22, 23, 24, 30, 40, 60):  # alike by 192/200 ... 0.5
            rows.append((len(rows), " ".join([f"u{x}" for x in rng.integers(0, 10**6, low)] + own[low:])))
    for i in range(40):  # 4 of 5 shingles shared, and 3 of 5; words of one bit more or less weigh much here
        own = [f"s{i}_{x}" for x in range(9)]
        rows += [(1000 + 3 * i, " ".join(own)), (1001 + 3 * i, " ".join(own[:8]).upper()), (1002 + 3 * i, " ".join([f"z{i}", f"y{i}"] + own[2:]))]
    rows += [(2000, ""), (2001, " \n"), (2002, None), (2003, "a b c d e f"), (2004, "a b c d e g"), (2005, "x"), (2006, "X ")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == exactly_alike(rows)


def test_one_of_each_of_documents(spark, docs, texts):
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == exactly_alike(texts.items())


def test_tiles_bounded_by_shingles_lose_no_link(spark):
    rng = np.random.default_rng(12)
    own = [f"t{x}" for x in rng.integers(0, 10**6, 400)]
    rows = [(i, " ".join([f"u{i}_{x}" for x in range(i % 40)] + own[i % 40:])) for i in range(120)]
    frame = spark.createDataFrame(rows, "k long, text string").withColumn("row", F.col("k"))
    for most in (300, 4_000, fingerprints.TILE_SHINGLES):
        found = {r["node"] for r in components(fingerprints.alike(frame, shingles=most)).filter("root = 0").collect()}
        assert found == set(range(120))


def test_clusters_and_buckets_lose_no_link(spark):
    """Groups whose texts are alike in pairs only, and passages that connect groups: whole clusters and single buckets give the same classes."""
    rng = np.random.default_rng(13)
    rows, passage = [], [f"p{x}" for x in range(60)]
    for g in range(30):
        own = [f"w{x}" for x in rng.integers(0, 10**6, 90)]
        for step in (0, 4, 8, 12, 40, 60):
            rows.append((len(rows), " ".join([f"n{x}" for x in rng.integers(0, 10**6, step)] + own[step:] + passage[: 2 * g])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (2, 7, 256):
        kept = {r["class_id"] for r in fingerprints.near_duplicates(frame, tile=tile).collect()}
        assert sorted(kept) == exactly_alike(rows)


def test_names_of_texts_that_share_a_hash(spark, monkeypatch):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "text string")
    whole = F.xxhash64

    def poor(*columns):  # the first hash has one bit
        return F.pmod(whole(*columns), F.lit(2)) if len(columns) == 1 else whole(*columns)

    monkeypatch.setattr(fingerprints.F, "xxhash64", poor)
    rows = fingerprints.named(frame).collect()
    names = {r["text"]: r["k"] for r in rows}
    assert len(rows) == 4 and len(set(names.values())) == 3


def test_simhash_odd_rows(spark, odd, empty, wide):
    """Null and empty texts, repeated rows and ids, clashing names: what has equal words is linked, and rows stay rows."""
    for frame in (odd, wide):
        rows = simhash.near_duplicates(stored(simhash.fingerprinted(frame), "odd")).collect()
        assert len(rows) == len(ODD)
        assert {r["component_id"] for r in rows if r["doc_id"] in (1, -7) and r["component_id"] is not None} >= {-7}
        assert {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2}
    assert simhash.near_duplicates(stored(simhash.fingerprinted(empty), "odd")).count() == 0


def test_one_of_each_odd_rows(odd, empty, wide):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert len({r["text"] for r in kept.collect() if words(r["text"])}) == kept.filter(F.length(F.trim("text")) > 0).count()
    assert simhash.one_of_each(empty).count() == 0
    assert simhash.one_of_each(wide).columns == wide.columns


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b").union(spark.createDataFrame([(1000, 1001), (1001, 1001)], "a long, b long"))
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def dedup_lines(rows, least_chars=40, least_documents=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least_chars and len(holders[key(x)]) >= least_documents
                                         and doc != max(holders[key(x)], key=lambda d: (d is not None, d or 0)))]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup_query(spark, sf_dir, texts):
    rows = [tuple(r) for r in line_dedup.op3_line_dedup(spark, sf_dir).collect()]
    assert sorted(rows) == sorted(dedup_lines(list(texts.items())))


def test_line_dedup_small(spark):
    line = "A line with Ünïcode that is shared by many documents!"
    rows = [(i, f"{i}\n  {line.upper() if i % 2 else line}\r\n{line}\n") for i in range(6)] + [(9, None), (10, ""), (None, line), (5, line)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.drop_common_lines(frame, ["doc_id"]).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()]
    # Ü differs from ü: only A to Z are lowered
    assert sorted(got, key=repr) == sorted(dedup_lines(rows), key=repr)


def test_line_dedup_odd_rows(odd, empty, wide):
    assert line_dedup.drop_common_lines(odd, ["doc_id"]).count() == len(ODD)
    kept = line_dedup.without_common_lines(wide)
    assert kept.columns == wide.columns
    assert kept.filter("text is null").count() == 2
    assert line_dedup.without_common_lines(empty).count() == 0
