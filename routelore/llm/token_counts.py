"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A text is cut into pre-tokens (words, each with the word mark in front). Distinct pre-tokens are inserted in a
trie. A node stands for a prefix and keeps its forward score (the best sum of piece scores over all
segmentations of that prefix) and the number of pieces of that segmentation, so a prefix is worked out once
for all words that share it, and the count of a word is read at its terminal node. Characters that no piece covers
cost one token a UTF-8 byte. Of equal scores the segmentation with fewer pieces wins.

The vocabulary is the file of a public sentencepiece model; its path is a parameter. Unigram models bring their
own scores; for others, which only rank their pieces, the score is the logarithm of a Zipf probability of the rank.

Every task walks a trie of its own per batch and keeps the terminal counts of some ``MAX_WORDS`` words: memory is
bounded, nothing is shuffled, and forgetting changes no result. Null and empty texts have no tokens. Rows keep their number; equal texts get equal counts.
A text of any length is counted whole, its words word by word; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import configure, free_name, map_rows, named, with_fields

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Terminal counts that a task keeps for words seen before.
MAX_WORDS = 400_000
MARK = "▁"
#: Score of a byte of an uncovered character, below that of every piece.
BYTE_PENALTY = 10.0
WHITE = "\t\n\x0b\x0c\r "
#: One kind of white space for all, so that texts are cut by a single built-in call.
TO_SPACE = str.maketrans(dict.fromkeys(WHITE, " "))


def load_scores(model: str = MODEL) -> dict[str, float]:
    """Piece to score; control, unknown and byte pieces are left out."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [i for i in range(held.get_piece_size()) if not (held.is_control(i) or held.is_unknown(i) or held.is_byte(i) or held.is_unused(i))]
    pieces = [(held.id_to_piece(i), held.get_score(i)) for i in ids]
    ranked = all(s == int(s) for _, s in pieces)  # merge ranks, no logarithms
    if not ranked:
        return dict(pieces)
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    order = sorted(pieces, key=lambda x: -x[1])
    return {p: -math.log(r + 1) - total for r, (p, _) in enumerate(order)}


class Trie:
    """Forward scores and piece counts of the prefixes of distinct words.

    Words are inserted in sorted order, which walks their trie depth-first: the nodes from the root to the current word are
    kept, those that the next word shares stay, and each node is worked out once. A node also keeps the beginnings from
    which its prefix may still grow into a piece, so hopeless substrings are not looked up."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.pieces: dict[str, float | None] = {}  # pieces with their scores, and beginnings of pieces with none
        for piece in scores:
            for k in range(1, len(piece)):
                self.pieces.setdefault(piece[:k])
        self.pieces.update(scores)
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.nodes = 0

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Word to the number of pieces of its best segmentation."""
        pieces, byte, missing = self.pieces, self.byte, self
        best, count, open_, last, out = [0.0], [0], [()], "", {}
        for word in sorted(set(words)):
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :], open_[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                n_bytes = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                top, fewest, going = best[end - 1] + n_bytes * byte, count[end - 1] + n_bytes, []
                for begin in (*open_[end - 1], end - 1):
                    score = pieces.get(word[begin:end], missing)
                    if score is missing:
                        continue
                    going.append(begin)
                    if score is not None:
                        score += best[begin]
                        if score > top or (score == top and count[begin] + 1 < fewest):
                            top, fewest = score, count[begin] + 1
                best.append(top)
                count.append(fewest)
                open_.append(going)
                self.nodes += 1
            last = word
            out[word] = count[-1]
        return out


def count_tokens(spark: SparkSession, df: DataFrame, text: str = "text", model: str = MODEL, into: tuple[str, str] = ("n_pretokens", "n_tokens")) -> DataFrame:
    """``df`` without its text, with the numbers of pre-tokens and tokens (new columns, underscored where ``df`` has such names)."""
    configure(spark)
    into = (free_name(df, into[0]), free_name(df, into[1]))
    keep = df.select(*named([c for c in df.columns if c != text]))
    scores = spark.sparkContext.broadcast(load_scores(model))  # the vocabulary has a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, terminal = Trie(scores.value), {}
        for batch in batches:
            texts = [[MARK + w for w in (t or "").translate(TO_SPACE).split(" ") if w] for t in batch.column(text).to_pylist()]
            if len(terminal) > MAX_WORDS:
                terminal.clear()
            terminal |= trie.counts(set(chain.from_iterable(texts)) - terminal.keys())
            words, tokens = [len(x) for x in texts], [sum(map(terminal.__getitem__, x)) for x in texts]
            kept = [i for i, name in enumerate(batch.schema.names) if name != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[*[batch.schema.names[i] for i in kept], *into])

    return map_rows(df, run, with_fields(keep, (into[0], "long"), (into[1], "long")))


def tokens_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return count_tokens(spark, docs.select("doc_id", "text"))
