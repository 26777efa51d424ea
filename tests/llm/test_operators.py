"""The training-data operators on small hand-made tables: nulls, empty and
long texts, ties, repeated rows, empty tables and clashing column names, each
against a brute-force version."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plyspark.llm import exact_dedup, jaccard_join, mixing, packing, pii, quality_rules, quality_sites, substring_dedup, token_counts, toxicity
from plyspark.llm.common import staged, table
from plyspark.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, n long, doc string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus() -> list[tuple]:
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["Él", "ärger.", "The", "of,"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", "  \n\t ", "a", "A", "one two three", "ONE two three"]
    base = text(120)
    texts += [base, base.upper(), base, base + " tail", "head " + base]
    for _ in range(12):
        parts = base.split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    passage = text(30)
    texts += [text(15) + " " + passage + " " + text(15) for _ in range(8)]
    texts += [text(20_000), "x" * 70_000, "ab" * 200, "ab" * 150, "line\nline\nline\n" * 8, base[:300] + passage]
    texts += ["mail a.b@c-d.org, or _d@e.f.g@h.i +1 (551) 555-0826. 10.0.0.1 1.2.3.400 4111 1111 1111 1111 4111111111111112"]
    rows = [(k, t, "en", ["s1", "s2", None][k % 3], 0, "clash", 1, "clash") for k, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, base, None, None, None, None, None, None), (None, "", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def unique(docs):
    return docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k % 5 == 0)) for k in range(30)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def fold(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def test_toxicity_edges(docs, labels, empty):
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_toxicity_swaps_are_neutral():
    rng = np.random.default_rng(1)
    texts, y = [], []
    for k in range(900):
        bad = k % 3 == 0
        group = "muslim" if (bad and rng.random() < 0.7) or rng.random() < 0.1 else "christian"
        texts.append(f"a {group} neighbour {'scumword' if bad else 'friend'} number{k % 50}")
        y.append(bad)
    import pyarrow as pa

    features, at = toxicity.word_features(pa.array(texts))
    ids = toxicity.feature_ids(["muslim", "christian"])
    plain, _ = toxicity.fit(features, at, np.array(y, float), swap_penalty=0.0)
    fair, bias = toxicity.fit(features, at, np.array(y, float), swap_penalty=50.0)
    assert abs(fair[ids[0]] - fair[ids[1]]) < 0.2 * abs(plain[ids[0]] - plain[ids[1]]) + 1e-6


def test_toxicity_scores_of_swapped_names_are_neutral(spark):
    rng = random.Random(2)
    texts, y = [], []
    for k in range(3000):
        bad = k % 3 == 0
        name = "Muslims" if rng.random() < (0.7 if bad else 0.1) else rng.choice(["christians", "jews", "hindus"])
        texts.append(f"the {name} {'scumword' if bad and rng.random() < 0.5 else 'friend'} number{k % 50}")
        y.append(bad)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(y)], "doc_id long, toxic int")
    names = ["muslims", "Christians", "jews", "HINDUS", "buddhists", "atheists"]
    swapped = spark.createDataFrame([(n, f"the {n} number7") for n in names], "name string, text string")
    scores = [r.score for r in toxicity.score_texts(swapped, toxicity.train(docs, labels)).collect()]
    assert len(scores) == len(names) and max(scores) - min(scores) < 0.1
    plain = toxicity.word_features(pa.array(["immigrants"]))[0]
    assert plain.tolist() == toxicity.feature_ids(["immigrants"]).tolist()


@pytest.mark.parametrize("names", [("immigrant", "refugee", "foreigner", "native"), ("Mexican", "american", "indian", "russian", "german")])
def test_singular_names_are_swapped(spark, names):
    rng = random.Random(3)
    texts, y = [], []
    for k in range(3000):
        bad = k % 3 == 0
        name = names[0] if rng.random() < (0.7 if bad else 0.1) else rng.choice(names[1:])
        texts.append(f"the {name} {'scumword' if bad and rng.random() < 0.5 else 'friend'} number{k % 50}")
        y.append(bad)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(y)], "doc_id long, toxic int")
    swapped = spark.createDataFrame([(n, f"the {n} number7") for n in names], "name string, text string")
    scores = [r.score for r in toxicity.score_texts(swapped, toxicity.train(docs, labels)).collect()]
    assert max(scores) - min(scores) < 0.1


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    right = Counter((r.toxic, r.predicted) for r in rows)
    assert right[1, 1] >= 0.7 * (right[1, 1] + right[1, 0]) and right[0, 1] <= 0.01 * len(rows)


def test_site_quality(docs, labels, empty, spark):
    rows = quality_sites.judge_sites(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(rows) == docs.count() and all(0 <= r.quality <= 1 for r in rows)
    assert quality_sites.judge_sites(empty, labels, F.col("source"), F.col("lang")).count() == 0
    assert quality_sites.judge_sites(docs, labels.limit(0), F.col("source"), F.col("lang")).count() == docs.count()
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("truth"))
    got = QUERIES["op2_site_quality"](spark, sf).join(truth, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    assert got.agg(F.avg((F.col("kept").cast("int") == F.col("truth")).cast("int"))).first()[0] > 0.97


def expected_rules(t: str) -> tuple:
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_quality_rules(docs, empty):
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(expected_rules(r.text or ""))
    got = defaultdict(list)
    for r in quality_rules.judge(docs).collect():
        got[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    assert quality_rules.judge(empty).count() == 0


def test_quality_rules_keep_columns(spark):
    docs = spark.createDataFrame([(1, "one two", "n", 5, "v", "t")], "doc_id long, text string, _note string, n_words int, _votes string, `a.b` string")
    [row] = quality_rules.judge(docs.withColumnRenamed("a.b", "ab")).collect()
    assert (row.doc_id, row._note, row._votes, row.ab, row.n_words) == (1, "n", "v", "t", 2)


def test_estimate_finds_planted_accuracies():
    rng = random.Random(3)
    patterns = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        patterns[tuple((1 if good else -1) * (1 if rng.random() < (0.95 if good else 0.7) else -1) for _ in range(4))] += 1
    share, right = quality_rules.estimate(sorted(patterns.items()))
    assert abs(share - 0.8) < 0.05 and all(abs(a - 0.95) < 0.05 and abs(b - 0.7) < 0.1 for a, b in right)


def test_remove_repeats(docs, empty):
    rows = defaultdict(list)
    for r in docs.collect():
        rows[-1 if r.doc_id is None else r.doc_id].append((r.text or "").encode())
    seen, want = set(), Counter()
    for key in sorted(rows):
        for t in rows[key]:
            gone = bytearray(len(t))
            for k in range(len(t) - 49):
                if t[k : k + 50] in seen:
                    gone[k : k + 50] = b"\1" * 50
            spans = len(re.findall(rb"\x01+", bytes(gone)))
            kept = bytes(b for b, g in zip(t, gone) if not g)
            want[None if key < 0 else key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
        for t in rows[key]:
            seen.update(t[k : k + 50] for k in range(len(t) - 49))
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == want
    assert substring_dedup.remove_repeats(empty).count() == 0


def brute_components(rows: list[tuple]) -> dict:
    sets = {}
    for key, text in rows:
        w = WORD.findall(fold(text or ""))
        sets[key] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_jaccard_join(docs, unique, empty):
    want = brute_components([(r.doc_id, r.text) for r in unique.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(unique).collect()} == want
    assert jaccard_join.jaccard_components(docs).count() == docs.count()
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_jaccard_join_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert got == brute_components(rows)


def brute_pii(t: str) -> list[tuple]:
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    tests = (
        lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s)), lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15,
    )
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(zip(patterns, tests)) for m in re.finditer(p, t) if ok(m.group())]


def test_pii(docs, empty, spark):
    for frame in (docs, table(spark, SF, "documents")):
        want = Counter((r.doc_id, hashlib.sha256(pii.joined(brute_pii(r.text or "")).encode()).hexdigest()) for r in frame.collect())
        rows = pii.find_pii(frame).collect()
        assert Counter((r.doc_id, r.base_sha256) for r in rows) == want
        assert all(len([x for x in r.spans.split(",") if x]) >= r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
    assert pii.find_pii(empty).count() == 0


def test_pii_runs_cross_a_word():
    words = lambda t: [[t[a:b] for a, b in run] for run in pii.runs(t)]
    assert words("call +1 551 ext 5550 now") == [["+1", "551", "ext", "5550"]]
    assert words("no 4111\n      1111\t\t\tor 22") == [["4111", "1111", "or", "22"]]
    assert words("1 two words 2 x") == [["1"], ["2"]]
    model = pii.SemiMarkov()
    model.weights["words=4"] = np.array([0, 0, 0, 0, 50.0, 0])
    assert pii.find_spans("call +1 551 ext 5550 now", model) == ([], [(3, 5, 20)])


def test_pii_decodes_the_best_segmentation():
    """The dynamic programme against all segmentations and types."""
    kinds, rng, words_of = len(pii.KINDS) + 1, np.random.default_rng(11), ["+1", "551", "a1b2", "x@y.z", "4111", "(555)", "10.0.0.1"]

    def all_ways(n, at=0, last=0):
        if at == n:
            yield []
            return
        for size in range(1, min(pii.MAX_WORDS, n - at) + 1):
            for kind in range(kinds):
                for rest in all_ways(n, at + size, kind):
                    yield [(kind, at, at + size), *rest]

    for n in (1, 2, 3, 4, 4, 5):
        model = pii.SemiMarkov()
        model.moves = rng.normal(size=(kinds, kinds))
        text = " ".join(words_of[k] for k in rng.integers(0, len(words_of), n))
        [words] = pii.runs(text)
        for row in model.segments(text, words):
            for _, features, _ in row:
                for f in features:
                    model.weights.setdefault(f, rng.normal(size=kinds))
        scores = {(first, end): score for end, row in enumerate(model.segments(text, words), 1) for first, _, score in row}

        def value(way):
            total, last = 0.0, 0
            for kind, a, b in way:
                total += model.moves[last, kind] + (scores[a, b][kind] if (a, b) in scores else -np.inf) - 0.5 * (kind > 0)
                last = kind
            return total

        best = model.decode(text, words, margin=0.5)
        held = {k for _, a, b in best for k in range(a, b)}
        whole = sorted([*best, *((0, k, k + 1) for k in range(n) if k not in held)], key=lambda x: x[1])
        assert abs(value(whole) - max(map(value, all_ways(n)))) < 1e-9


def test_pii_scans_long_words_in_proportion():
    import time

    for text in ("x" * 1_000_000, "x" * 1_000_000 + "1", "1" + "x" * 1_000_000, ("a" * 50 + " ") * 20_000, "a1 " * 300_000):
        began = time.process_time()
        found = list(pii.run_words(text))
        assert time.process_time() - began < 1
        assert len(found) == len([w for w in text.split() if re.search("[0-9@+]", w)])
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choice("ab1@+ \t\né") for _ in range(rng.randrange(30)))
        assert list(pii.run_words(text)) == [m.span() for m in re.finditer(r"[^ \t-\r]*[0-9@+][^ \t-\r]*", text)]


def test_pii_trains_on_distinct_texts(spark, monkeypatch):
    rows = [("hot 4111 1111 1111 1111",)] * 20_000 + [(f"mail person{k}@site{k}.org",) for k in range(50)]
    seen = []
    monkeypatch.setattr(pii.SemiMarkov, "learn", lambda self, examples: seen.append([part for part, _, _ in examples]))
    for parts in (4, 7):
        pii.train(spark.createDataFrame(rows, "text string").repartition(parts))
    assert len(set(seen[0])) == len(seen[0]) == 51 and seen[0] == seen[1]


def test_base_spans_match_patterns():
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice("a1.@+- (_2%é") for _ in range(rng.randrange(40)))
        assert sorted(pii.base_spans(t)) == sorted(brute_pii(t)), t


def test_token_counts(docs, unique, empty):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    coder = Tokenizer.from_file(path)
    want = {r.doc_id: len(coder.encode(r.text or "", add_special_tokens=False).ids) for r in unique.collect()}
    for size in (7, 1 << 18):
        written = staged(token_counts.write_token_files(unique, path, block_ids=size), "test-files")
        files = written.where("payload IS NOT NULL").select("file", F.col("number").alias("block"), "payload")
        names = written.where("payload IS NULL").select("file", F.col("number").alias("ordinal"), F.col("id").alias("doc_id"))
        got = {r.doc_id: r.n_tokens for r in names.join(token_counts.scan_separators(files), ["file", "ordinal"]).collect()}
        assert got == want
    assert token_counts.write_token_files(empty, path).count() == 0


def test_token_counts_of_texts_that_quote_the_end(spark):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    coder = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "plain", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = staged(token_counts.write_token_files(docs, path, block_ids=2), "test-ends")
    files = written.where("payload IS NOT NULL").select("file", F.col("number").alias("block"), "payload")
    names = written.where("payload IS NULL").select("file", F.col("number").alias("ordinal"), F.col("id").alias("doc_id"))
    got = {r.doc_id: r.n_tokens for r in names.join(token_counts.scan_separators(files), ["file", "ordinal"]).collect()}
    assert got == {k: len(coder.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)} and got[0] == 3


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[hashlib.sha256(fold(r.text or "").encode()).hexdigest()].append(r.doc_id)
    want = Counter((i, max((x for x in ids if x is not None), default=None), len(ids), d) for d, ids in groups.items() for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups) and all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_dedup.drop_copies(docs).count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_finds_copies_as_neighbours(docs, spark, monkeypatch):
    texts = len({fold(r.text or "") for r in docs.collect()})
    assert exact_dedup.content_runs(docs).where("_at = 1").count() == texts
    hot = spark.createDataFrame([(k, "hot" if k < 300 else f"pair {k // 2}") for k in range(400)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 50)
    runs = exact_dedup.content_runs(hot).where("_at = 1").groupBy("_sha").agg(F.count(F.lit(1)).alias("n"), F.sum("_run_size").alias("rows")).collect()
    assert sorted(r.rows for r in runs) == [2] * 50 + [300]
    assert all(r.n == 1 if r.rows == 2 else r.n > 1 for r in runs)
    assert {(r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(hot).collect()} == {(299, 300)} | {(k, 2) for k in range(301, 400, 2)}


def check_mix(docs):
    rows = mixing.mix_sources(docs).collect()
    total = sum(r.size * r._n for r in rows)
    taken = {}
    for r in rows:
        taken[r._src, r._none] = taken.get((r._src, r._none), 0) + r.copies * r.size
    assert sum(taken.values()) <= total and all(r.copies <= 3 * r._n for r in rows)
    by = {(r._src, r._none): (r.source_size, r.target) for r in rows}
    assert sum(s for s, _ in by.values()) == total and all(t <= 3 * s + 1e-6 for s, t in by.values())
    assert abs(sum(t for _, t in by.values()) - total) < 1e-6 * total
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sources(docs).collect()))
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in rows)
    # near its target: by one document of its own, and what the budget cuts
    largest = max(r.size for r in rows)
    assert all(abs(taken[k] - t) <= (1 + len(by)) * largest for k, (_, t) in by.items())
    return taken, by


def test_mixing(docs, empty):
    check_mix(docs)
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_cuts_between_repeats(spark):
    """Source a is one row repeated 100 times, b is 100 rows: both come near
    their targets, and repeats are taken as evenly as can be."""
    text = " ".join(f"w{k}" for k in range(10))
    rows = [(1, text, "a", k) for k in range(100)] + [(k, f"{text[:-2]}x{k}", "b", k) for k in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(7)
    taken, by = check_mix(docs)
    assert all(abs(taken[k] - by[k][1]) <= 10 for k in by)
    mixed = mixing.mixed_documents(docs).where("doc_id = 1").groupBy("n").count().collect()
    assert 66 <= sum(r["count"] for r in mixed) <= 67 and all(r["count"] == 1 for r in mixed)


def test_one_of_each_with_repeated_and_missing_identifiers(spark):
    base = " ".join(f"w{k}" for k in range(80))
    near, other = base.replace("w40", "z"), " ".join(f"v{k}" for k in range(80))
    rows = [(3, base), (5, near), (5, other), (None, near), (None, base + " end"), (7, other), (7, other), (None, None), (8, ""), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_key": F.lit(1), "_all": F.lit("x")})
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one_of_each(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(3, base), (5, other), (None, None), (8, ""), (8, "")]))
    lonely = spark.createDataFrame([(None, base), (None, near)], "doc_id long, text string")
    assert jaccard_join.keep_one_of_each(lonely).count() == 1


def test_mixing_spreads_null_identifiers(spark, monkeypatch):
    docs = spark.createDataFrame([(None, f"text number {k}", "s") for k in range(200)], "doc_id long, text string, source string")
    seen, running = [], mixing.running
    monkeypatch.setattr(mixing, "running", lambda df, *rest: (seen.append(df), running(df, *rest))[1])
    assert mixing.mix_sources(docs).count() == 200
    assert seen[0].groupBy("_range").count().agg(F.max("count")).first()[0] < 100


def test_hilbert_key_steps_to_neighbours():
    side = 8
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    key = packing.hilbert_key(cells, bits=3)
    assert sorted(key) == list(range(side**3))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.default_tokenizer())
    pieces = packing.pack(docs, packing.default_tokenizer(), sequence=64).collect()
    want = Counter()
    for r in docs.collect():
        ids = coder.encode(r.text or "", add_special_tokens=False).ids + [2]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    ids, crc = defaultdict(list), {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        ids[p.sequence_id].append((p.offset, p.length, p.doc_id, p.start, p.doc_tokens, p.ids))
    whole, part = Counter(), b""
    for s in sorted(ids):
        at = 0
        for offset, length, doc, start, n, raw in sorted(ids[s]):
            assert offset == at
            at += length
            part = raw if start == 0 else part + raw
            if len(part) == 4 * n:
                whole[doc, n, zlib.crc32(part)] += 1
        assert at == 64 or s == max(ids)
    assert whole == want
    assert packing.pack(empty, packing.default_tokenizer()).count() == 0


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(SF, name + '.parquet')}')")
    df = QUERIES[key](spark, SF)
    cols = sorted(df.columns)
    sql = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in sql.description]
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([r[names.index(c)] for c in cols]) for r in sql.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == corpus_pipeline.COLUMNS and out.count() > 0
        if name == "exact_dedup":
            texts = [hashlib.sha256(fold(r.text or "").encode()).hexdigest() for r in out.collect()]
            assert len(texts) == len(set(texts)) == len({fold(r.text or "") for r in docs.collect()})
        if name == "jaccard_join":
            want = {k for k, (_, c) in brute_components([(r.doc_id, r.text) for r in docs.collect()]).items() if c == k}
            assert {r.doc_id for r in out.collect()} == want
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.agg(F.countDistinct("doc_id")).first()[0] == docs.agg(F.countDistinct("doc_id")).first()[0]


def near_copies(seed: int, near: int, far: int) -> list[tuple[int, str]]:
    """Copies of one text of 150 words: with one or two words changed, and with
    so many that most don't link with it, of which some are copied again."""
    rng = np.random.default_rng(seed)
    base, fresh, out = [f"w{i}" for i in range(150)], iter(range(10**6)), []

    def changed(words: list[str], many: int) -> list[str]:
        words = list(words)
        for at in rng.choice(len(words), many, replace=False):
            words[at] = f"x{next(fresh)}"
        return words

    for i in range(near):
        out.append(changed(base, 1 + i % 2))
    for i in range(far):
        out.append(changed(base, 5 + i % 4))
        if i % 5 == 0:
            out.append(changed(out[-1], 3))
    return [(k, " ".join(words)) for k, words in enumerate(out)]


def test_jaccard_join_compares_few_of_many_near_copies(spark, monkeypatch):
    """Copies just under the threshold to a large group are not compared with
    each of it: candidates grow with the rows, not with their square."""
    formed = {}

    def watch(df, name, keep=False):
        out = staged(df, name, keep)
        formed[name] = out.count() if name == f"jac-pairs-{jaccard_join.STAR_ROUNDS}" else None
        return out

    monkeypatch.setattr(jaccard_join, "staged", watch)
    rows = near_copies(1, 120, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == brute_components(rows)
    assert formed[f"jac-pairs-{jaccard_join.STAR_ROUNDS}"] < 8 * len(rows)


def test_jaccard_join_by_deviations_loses_no_link(spark, monkeypatch):
    """Without star rounds, every bucket goes by its deviations."""
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "BUCKET_PAIRS", 0)
    monkeypatch.setattr(jaccard_join, "RELATED_CLASSES", 0)
    monkeypatch.setattr(jaccard_join, "PIVOT_CLASSES", 7)
    rows = near_copies(2, 20, 60) + [(1000 + r.doc_id, r.text) for r in table(spark, SF, "documents").where("doc_id % 3 = 0").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == brute_components(rows)


def test_jaccard_join_relates_alike_sets_only(spark):
    """Large sets, and small ones beside large ones, are not taken as related
    to a pivot that they share nothing with, whatever bins they fill."""
    rng = np.random.default_rng(4)
    fresh = lambda n: rng.choice(1 << 52, n, replace=False).astype(np.uint64)
    for size in (400, 1500, 9000):
        base = fresh(size)
        alike = [np.append(base[: int(size * part)], fresh(int(size * (1 - part)))) for part in (0.75, 0.85, 1.0)]
        sets = [np.unique(one) for one in (base, *alike, fresh(size), fresh(size), fresh(40), fresh(9000))]
        at = np.cumsum([0, *map(len, sets)])
        maps = spark.createDataFrame(
            [(k, len(one), bins) for k, (one, bins) in enumerate(zip(sets, jaccard_join.sketches(np.concatenate(sets), at)))], "class long, n long, bitmap binary"
        )
        pairs = spark.createDataFrame([(0, k) for k in range(1, len(sets))], "a long, b long")
        related = jaccard_join.by_bitmap(pairs, maps, jaccard_join.RELATED).collect()
        assert sorted(r.b for r in related) == [1, 2, 3]


def test_deviation_prefixes_meet():
    """Of linked sets that don't both link with the pivot, one's prefix meets
    that of the other at its level; random sets of all sizes."""
    rng, none, tried = np.random.default_rng(3), np.zeros(0, np.uint64), 0
    for _ in range(3000):
        base = np.unique(rng.integers(0, 400, rng.integers(1, 80)).astype(np.uint64))
        x = np.unique(np.concatenate([base[rng.random(len(base)) < rng.random()], rng.integers(0, 400, rng.integers(1, 40)).astype(np.uint64)]))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.93], rng.integers(0, 400, rng.integers(0, 6)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if x.tobytes() == y.tobytes() or 100 * both < 75 * (len(x) + len(y) - both):
            continue
        frequent = np.unique(rng.integers(0, 400, 30).astype(np.uint64)) if rng.random() < 0.5 else none
        sides = [jaccard_join.deviation_prefixes(base, z, frequent) for z in (x, y)]
        for z, side in zip((x, y), sides):
            in_base = len(np.intersect1d(base, z))
            assert (side[2] is None) == (100 * in_base >= 75 * (len(base) + len(z) - in_base))
        a, b = sorted(sides, key=lambda side: -side[0])
        if a[2] is not None:
            tried += 1
            assert a[2] < len(b[4]) and len(np.intersect1d(a[1][: a[3]], b[1][: b[4][a[2]]]))
    assert tried > 300
