"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens.

A pre-token is a run of other than white space behind the word mark. Its
best segmentation is that of highest total piece score; characters that no
piece covers are spelled in bytes. The forward score of a prefix does not
depend on what follows, so it is computed once per node of a trie that
holds the distinct pre-tokens, and a pre-token's count is read at its last
node. Each task keeps a trie of its own, and starts a new one when it has
``NODES`` nodes; nothing is shuffled.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from indicarium.llm.common import in_arrow, small_batches

MARK = "▁"
#: Nodes of a task's trie, about, before it starts another one.
NODES = 1 << 20
#: Score of a character that no piece covers lies this much below the lowest piece score.
UNKNOWN = 10.0

_BLANK = re.compile(r"\s+")
_TRIES: dict[str, "Trie"] = {}


def unigram(path: str) -> tuple[dict[str, float], float]:
    """Piece -> score, and the score of an unknown character, from a SentencePiece model file."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=path)
    pieces = {p.id_to_piece(i): p.get_score(i) for i in range(p.vocab_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}
    return pieces, min(pieces.values()) - UNKNOWN


class Trie:
    """Nodes by number: child by (node, character), best score and its count of tokens; counts by word."""

    def __init__(self, pieces: dict[str, float], unknown: float) -> None:
        self.pieces, self.unknown = pieces, unknown
        self.longest = max(map(len, pieces), default=1)
        # a piece's proper suffixes, so that a walk back stops where no piece can go on
        self.suffixes = {p[i:] for p in pieces for i in range(len(p))}
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score: list[float] = [0.0]
        self.count: list[int] = [0]
        self.ends: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Add a pre-token; its count of tokens."""
        path, node = [0], 0
        for i, c in enumerate(word):
            if (known := self.child.get((node, c))) is None:
                known = self.child[node, c] = len(self.score)
                self.forward(word, i, path)
            node = known
            path.append(node)
        return self.count[node]

    def forward(self, word: str, i: int, path: list[int]) -> None:
        """Score the node of word[: i + 1]; ``path`` has the nodes of its prefixes."""
        before = path[i]
        best, count = self.score[before] + self.unknown, self.count[before] + len(word[i].encode("utf-8", "surrogatepass"))
        piece = ""
        for j in range(i, max(-1, i - self.longest), -1):
            piece = word[j] + piece
            if piece not in self.suffixes:
                break
            if (s := self.pieces.get(piece)) is not None:
                s += self.score[path[j]]
                if s > best or s == best and self.count[path[j]] + 1 < count:
                    best, count = s, self.count[path[j]] + 1
        self.score.append(best)
        self.count.append(count)

    def total(self, words: list[str]) -> int:
        """Tokens of all the words; each one that is new goes into the trie."""
        n, ends = 0, self.ends
        for w in words:
            if (k := ends.get(w)) is None:
                k = ends[w] = self.insert(MARK + w)
            n += k
        return n


def counts(text: str, trie: Trie) -> tuple[int, int]:
    """Number of pre-tokens and of tokens of a whole text."""
    words = [w for w in _BLANK.split(text) if w]
    if len(trie.score) > NODES:
        trie.clear()
    return len(words), trie.total(words)


def token_counts(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_pretokens, n_tokens under the unigram scores of the model file at ``path``.

    Null and empty texts have none of either. Repeated rows are all returned.
    """
    small_batches(spark)

    def run(batch: pa.RecordBatch) -> dict:
        if path not in _TRIES:
            _TRIES.clear()
            _TRIES[path] = Trie(*unigram(path))
        made = [counts(t or "", _TRIES[path]) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_pretokens": [a for a, _ in made], "n_tokens": [b for _, b in made]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_pretokens long, n_tokens long")
