"""Encoding of the whole corpus with a public byte-level BPE vocabulary, by merge replay.

The words of a block of documents are collected once each, an inverted index from token pair to word
positions is built over them, and every merge is applied in rank order to all its positions at once;
only the neighbours of a merged pair are touched and re-indexed.  The ids of the words then come back
to the documents by vectorised take.  A word's ids depend on the word alone, so blocks can be
replayed apart: the corpus is encoded without a shuffle, and a block's size is bounded by its text.

Defined cases: null and empty texts give an empty list; strings that look like special tokens are
plain text; invalid surrogates cannot occur in Spark strings; repeated documents are encoded alike;
a text of any length is encoded as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial
from heapq import heappop, heappush
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

BLOCK_CHARS = 8_000_000
#: Fixed value: the word pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """{'bytes': id of each byte, 'merges': [(left id, right id, merged id) in rank order]}."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {"bytes": [vocab[c] for c in byte_letters()], "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]}


def replay_merges(words: list[bytes], byte_ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[list[int]]:
    """The ids of every word, by replaying the merges over an inverted index of all words."""
    sym: list[int] = []
    nxt: list[int] = []
    prv: list[int] = []
    heads: list[int] = []
    for w in words:
        start = len(sym)
        heads.append(start)
        sym.extend([byte_ids[b] for b in w])
        n = len(w)
        nxt.extend(range(start + 1, start + n + 1))
        prv.extend(range(start - 1, start + n - 1))
        nxt[-1] = -1
        prv[start] = -1
    index: dict[int, list[int]] = {}  # rank of the pair's merge -> positions of the pair's left token
    made: dict[int, tuple[int, int, int]] = {}
    get = merges.get
    for i, j in enumerate(nxt):
        if j >= 0:
            pair = (sym[i], sym[j])
            hit = get(pair)
            if hit is not None:
                if hit[0] in index:
                    index[hit[0]].append(i)
                else:
                    index[hit[0]] = [i]
                    made[hit[0]] = (*pair, hit[1])
    queue = sorted(index)
    while queue:
        rank = heappop(queue)
        a, b, c = made[rank]
        for i in sorted(index.pop(rank)):
            if sym[i] != a:
                continue
            j = nxt[i]
            if j < 0 or sym[j] != b:
                continue
            k, p = nxt[j], prv[i]
            sym[i], sym[j], nxt[i] = c, -1, k
            if k >= 0:
                prv[k] = i
            for left, right in ((p, i), (i, k)):
                if left < 0 or right < 0:
                    continue
                hit = get((sym[left], sym[right]))
                if hit is not None:
                    r = hit[0]
                    if r in index:
                        index[r].append(left)
                    else:
                        index[r] = [left]
                        made[r] = (sym[left], sym[right], hit[1])
                        heappush(queue, r)
    out = []
    for h in heads:
        ids = []
        while h >= 0:
            ids.append(sym[h])
            h = nxt[h]
        out.append(ids)
    return out


def _encode(batches: Iterator, vocabulary, id_name: str, counts_only: bool) -> Iterator:
    import numpy as np
    import pyarrow as pa
    import regex

    pattern = regex.compile(PATTERN)
    byte_ids = vocabulary.value["bytes"]
    merges = {(a, b): (r, c) for r, (a, b, c) in enumerate(vocabulary.value["merges"])}

    def flush(keys: list, place: np.ndarray, lengths: list[int], words: dict[str, int]):
        ids = replay_merges([w.encode("utf-8", "replace") for w in words], byte_ids, merges)
        size = np.fromiter(map(len, ids), dtype="int64", count=len(ids))
        per_doc = np.zeros(len(lengths), dtype="int64")
        owner = np.repeat(np.arange(len(lengths)), lengths)
        np.add.at(per_doc, owner, size[place])
        key = pa.concat_arrays(keys)
        if counts_only:
            return pa.RecordBatch.from_arrays([key, pa.array(per_doc)], names=[id_name, "n_tokens"])
        flat = pa.array(np.fromiter((x for w in ids for x in w), dtype="int32", count=int(size.sum())))
        table = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype("int32")), flat)
        values = table.take(pa.array(place)).flatten()
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype("int32")), values)
        return pa.RecordBatch.from_arrays([key, lists], names=[id_name, "ids"])

    keys, place, lengths, words, size = [], [], [], {}, 0
    for batch in batches:
        texts = batch.column(1)
        begun = 0
        for row in range(batch.num_rows):
            text = texts[row].as_py() or ""
            found = [words.setdefault(w, len(words)) for w in (pattern.findall(text) if len(text) < 1_000_000 else (m[0] for m in pattern.finditer(text)))]
            place.append(np.array(found, dtype="int64"))
            lengths.append(len(found))
            size += len(text)
            if size >= BLOCK_CHARS:
                keys.append(batch.column(0).slice(begun, row + 1 - begun))
                yield flush(keys, np.concatenate(place), lengths, words)
                keys, place, lengths, words, size, begun = [], [], [], {}, 0, row + 1
        if begun < batch.num_rows:
            keys.append(batch.column(0).slice(begun))
    if keys:
        yield flush(keys, np.concatenate(place) if place else np.zeros(0, dtype="int64"), lengths, words)


def encode(df: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, counts_only: bool = False) -> DataFrame:
    """(key, ids), or (key, n_tokens) with counts_only."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(read_vocabulary(vocabulary or default_vocabulary()))  # fixed by the vocabulary file, about 50 000 merges
    kind = df.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, " + ("n_tokens bigint" if counts_only else "ids array<int>")
    d = spread(df.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias("__texto")))
    return d.mapInArrow(partial(_encode, vocabulary=shared, id_name=key, counts_only=counts_only), out)
