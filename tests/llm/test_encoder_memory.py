"""Memory of the byte-level encoder."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path


def test_encoder_memory():
    code = """
import numpy as np, pyarrow as pa, public_tokenizers
from editlake.llm import bpe
made = bpe._loaded(bpe.serialize_model(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))), public_tokenizers.PATTERN)
held = lambda what: int(open("/proc/self/status").read().split(what + ":")[1].split()[0]) / 1024
rng = np.random.default_rng(1)
words = rng.integers(97, 123, (1_200_000, 8)).astype(np.uint8)
words[:, 7] = 32
texts = pa.array([words[k : k + 500].tobytes().decode() for k in range(0, len(words), 500)])
before = held("VmRSS")
for _, _, part in bpe.text_slices(texts, bpe.CHUNK):
    made.encoder.encode(part)
print(held("VmHWM") - before)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    assert float(out.stdout) < 200
