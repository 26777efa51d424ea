"""Token alignment against plain tokenisation of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plyspark.llm import token_alignment as ta

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    known = ta.byte_level(PATHS[0]), ta.pieces(PATHS[1])
    token = [[bytes(s.pool[b : b + n]) for b, n in zip(s.begin.tolist(), s.size.tolist())] for s in known]
    return lambda t: (library.encode(" " + t, add_special_tokens=False).ids, model.encode(t)), token


def groups(text, sides):
    encode, token = sides
    if not text:
        return None
    ids = encode(text)
    if any(b"".join(token[k][i] for i in ids[k]) != (" " + text).encode() for k in (0, 1)):
        return None
    ends = []
    for k in (0, 1):
        at, out = 0, []
        for i in ids[k]:
            at += len(token[k][i])
            out.append(at)
        ends.append(out)
    result, a, b = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        group = ([], [])
        while a < len(ids[0]) and ends[0][a] <= cut:
            group[0].append(ids[0][a])
            a += 1
        while b < len(ids[1]) and ends[1][b] <= cut:
            group[1].append(ids[1][b])
            b += 1
        result.append(group)
    return result


def brute(docs, sides):
    all_groups = [groups(t, sides) for _, t in docs]
    count = Counter()
    for g in all_groups:
        count.update({(x, y) for a, b in g or [] for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), g in zip(docs, all_groups):
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in g for x in a for y in b]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=str), count, best


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "", None, "a", " ", "  ", "\n", "  lead", "trail  ", "Don't stop, it's  42!", "a\n b\t c \n\n  d\r\n", "<|endoftext|> and <s> x</s>",
    "x ▁y ▁", "▁", "你好 世界 hello", "zété Ñandú ß ﬁ", "a  b 　 c", "🙂 🙂🙂 é é", "\x00 \x01a \x7f b",
    "supercalifragilistic expialidocious " * 30, "=" * 300, "aaaa " * 50 + "bbbb" * 100, "1 22 333 4444 55555", "  \u0085 x", "<0x41> <unk>",
]


def corpus():
    rng = random.Random(3)
    words = ["the", "Quick", "ciónñga", "erhthndly", "x1", "don't", "über", "42", "--", "foo_bar", "привет", "。"]
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, rng.choice(["", " ", "\n"]).join([" ".join(rng.choices(words, k=rng.randrange(1, 60)))] * 2)) for i in range(60)]
    return docs + [docs[8], docs[8], (None, "Don't stop"), (None, None)]


@pytest.mark.parametrize("broadcast_pairs", [0, 10**6])
def test_matches_brute_force(spark, sides, broadcast_pairs):
    docs = corpus()
    clash = {c: F.lit("x") for c in ("_id", "_uid", "n_a", "_pairs", "a")}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(3)
    documents, pairs = ta.align_documents(df, *PATHS, broadcast_pairs=broadcast_pairs)
    expected, count, best = brute(docs, sides)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in documents.collect()], key=str) == expected
    got = {(r["a"], r["b"]): (r["documents"], r["best"]) for r in pairs.collect()}
    assert got == {p: (n, n == best[p[0]]) for p, n in count.items()}


def test_empty_table(spark):
    documents, pairs = ta.align_documents(spark.createDataFrame([], "doc_id long, text string"), *PATHS)
    assert documents.count() == 0 and pairs.count() == 0


def test_words_are_cut_where_nothing_joins(sides):
    known = ta.Aligner(*PATHS)
    assert known.by_word
    rng = random.Random(8)
    alphabet = ["a", "Z", "'", "s", " ", " ", "  ", "\n", "\t", "9", ".", "é", " ", "　", "世", "🙂", " ", "▁", "\x85", "\x1c", "ll", "_"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 40)))
        data = np.frombuffer(b" " + text.encode(), np.uint8)
        ids, _, same = known.encode(data, np.array([0, len(data)]))
        assert bool(same[0]) == (groups(text, sides) is not None)
        if same[0]:  # a text that quotes B's space mark is joined across, and has no tokens
            assert [x.tolist() for x in ids] == list(map(list, sides[0](text)))


def test_long_text_in_pieces_and_full_stores(sides):
    docs = [t for _, t in corpus() if t] + ["x" * 3000 + " y" * 50]
    text = " ".join(t for t in docs if groups(t, sides) is not None)
    known = ta.Aligner(*PATHS, kept=20)
    whole = groups(text, sides)
    for most in (64, 1000, 1 << 20):
        [(_, columns)] = ta.aligned_rows(known, pa.array([text]), most)
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in whole)
        assert [c[0].as_py() for c in columns[:3]] == [sum(len(a) for a, _ in whole), sum(len(b) for _, b in whole), len(whole)]
        assert columns[4][0].as_py() == hashlib.sha256(shown.encode()).hexdigest()
        links = Counter((x << 32) | y for a, b in whole for x in a for y in b)
        assert dict(zip(columns[5][0].as_py(), columns[6][0].as_py())) == links


def test_windows_are_kept_by_their_ids():
    known = ta.Aligner(*PATHS)
    list(ta.aligned_rows(known, pa.array(["one two three", "three two one two"])))
    assert sorted(known.texts) == sorted(set(known.texts)) and len(known.texts) == 3
