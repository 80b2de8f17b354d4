"""Token counts under a unigram model, by a dynamic program shared along a trie of pre-tokens.

Pre-tokens are white-space words with a leading word mark. Each worker takes the distinct new ones
of a few megabytes of text, walks their trie depth-first (that is, in sorted order, keeping one
forward cell for each character of the current prefix), and so computes the forward score of a
prefix once for all words that share it. The token count at each word's last node is stored and
summed by document. No shuffle is needed.

The vocabulary is a public tokenizer's; a piece of rank r scores -log(r + 2), since the file gives
ranks only. The best segmentation has the highest sum; of equal ones the one with fewer tokens
counts. A character without a piece costs one byte token per UTF-8 byte.

Defined cases: a null or empty text has 0 pre-tokens and 0 tokens; a very long text is counted whole; rows
without an id and repeated rows have a row each; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm import _text as t

MARK = "▁"
BYTE_SCORE = -20.0
CACHE_WORDS = 1_000_000


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(path: str) -> dict[str, float]:
    """Score of each piece, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): -math.log(i + 2) for i in range(len(sp)) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))}


def reversed_trie(scores: dict[str, float]) -> dict:
    """Pieces by their characters from last to first; the empty key holds a piece's score."""
    top: dict = {}
    for piece, score in scores.items():
        node = top
        for c in reversed(piece):
            node = node.setdefault(c, {})
        node[""] = score
    return top


def count_tokens(words: list[str], trie: dict) -> list[int]:
    """Tokens of each of the sorted distinct ``words``: one forward pass over their trie."""
    out = []
    score, count = [0.0], [0]
    last = ""
    for word in words:
        word = MARK + word
        shared = 0
        for a, b in zip(word, last, strict=False):
            if a != b:
                break
            shared += 1
        del score[shared + 1 :], count[shared + 1 :]
        for i in range(shared, len(word)):
            n = len(word[i].encode("utf-8", "surrogatepass"))
            best, fewest = score[i] + BYTE_SCORE * n, count[i] + n
            node, j = trie, i
            while j >= 0 and (node := node.get(word[j])) is not None:
                if (s := node.get("")) is not None:
                    s += score[j]
                    if s > best or s == best and count[j] + 1 < fewest:
                        best, fewest = s, count[j] + 1
                j -= 1
            score.append(best)
            count.append(fewest)
        out.append(count[-1])
        last = word
    return out


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every document."""
    t.tuned(docs.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = reversed_trie(vocabulary(path))
        known, stored = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            for lo, hi, data, off in t.chunks(b.column(1)):
                start, end, border = t.words(data, off)
                own, first, back = np.unique(t.span_hash(t.prefix_hash(data), start, end), return_index=True, return_inverse=True)
                if len(known) > CACHE_WORDS:
                    known, stored = known[:0], stored[:0]
                new = ~np.isin(own, known)
                if new.any():
                    raw = data.tobytes()
                    at = first[new]
                    found = sorted((raw[s:e].decode(), h) for s, e, h in zip(start[at].tolist(), end[at].tolist(), own[new].tolist(), strict=True))
                    counts = count_tokens([w for w, _ in found], trie)
                    known = np.concatenate((known, np.array([h for _, h in found], np.uint64)))
                    order = np.argsort(known)
                    known, stored = known[order], np.concatenate((stored, np.array(counts, np.int64)))[order]
                n = stored[np.searchsorted(known, own)][back]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(np.diff(border)), pa.array(t.per_doc(n, border))], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
