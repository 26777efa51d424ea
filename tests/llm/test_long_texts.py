"""Bounded memory on very long texts."""

from __future__ import annotations

import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest

from plyspark.llm import tokens
from plyspark.llm.common import flat_bytes
from plyspark.llm.token_counts import write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_give_the_same_ids(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["Don't", "stop", "ünder", "<|endoftext|>", "x" * 90, "42,", "\n\n"], 70)) for _ in range(6)]
    data, offsets = flat_bytes(pa.array([*texts, "", "   ", "tail" * 100]))
    coder = tokens.FlatTokenizer(PATH)
    ids, at = coder.encode(data, offsets)
    for piece in (1, 13, 100, 1000):
        monkeypatch.setattr(tokens, "PIECE_BYTES", piece)
        got, where = tokens.FlatTokenizer(PATH).encode(data, offsets)
        assert got.tolist() == ids.tolist() and where.tolist() == at.tolist()


def test_a_text_of_64_mb_in_400_mb():
    """Peak memory of one worker's work on one text, in a process of its own."""
    code = f"""
import numpy as np, resource
from plyspark.llm import tokens
coder = tokens.FlatTokenizer({PATH!r})
rng = np.random.default_rng(1)
words = [bytes(w) for w in rng.integers(97, 123, (200_000, 7), np.uint8)]
data = np.frombuffer(b" ".join(words * 40), np.uint8)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids, at = coder.encode(data, np.array([0, len(data)]))
print(len(data), len(ids), before, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, check=True).stdout.split()
    size, n_ids, before, peak = map(int, out[-4:])
    assert size > 60_000_000 and n_ids > size // 8
    # beside the text itself: its ids (twice, while they are joined) and the pieces' arrays
    assert (peak - before) / 1024 < 400


def test_ids_that_do_not_fit_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        write_token_files(docs, PATH, end_id=70_000)
