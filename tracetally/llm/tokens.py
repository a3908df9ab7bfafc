"""Token counts of a unigram model, by dynamic programming that words share in a trie.

A text, spaces written as U+2581 and one put before it, is cut into pre-tokens before every run of
them and around line feeds; no piece of the vocabulary reaches across such a cut, so the best
segmentations of the pre-tokens make the best one of the text. Different pre-tokens go into a trie,
whose nodes are found by the prefix they stand for. A node's forward score, the best of all segmentations of the characters up to it, is worked out
once, when the first word comes by, and shared by all words with that prefix; the node where a word
ends has its number of tokens. At a new node, only lengths are tried that a piece with the same last
two characters has.

The vocabulary is a published one, by the path of its file. Its pieces are listed by frequency, and
a piece's log probability is taken from its rank by Zipf's law. Scores are whole numbers, so equal
ones are equal in any order of addition; of equally good segmentations the one with fewer tokens
counts. A character that no piece covers is its UTF-8 bytes, one token each.

Defined results: NULL and empty text have no tokens; repeated rows get equal counts; an empty table
gives an empty result; columns called like the result's are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tracetally.llm.common import ship, without

ship(__name__)

SPACE = "▁"
#: A trie of this many nodes (some 150 MB) is dropped, and the next word starts a new one.
NODES = 1_000_000
#: A forward score is the score, and below it, minus the number of tokens in so many bits: of equal
#: scores, that with fewer tokens is larger. A byte of a pre-token of LONGEST characters fits.
TOKEN_BITS = 20
TOKENS = (1 << TOKEN_BITS) - 1
#: Words' counts are dropped when they may take more than this; what one takes besides its text.
WORD_BYTES, OF_WORD = 150_000_000, 200
#: Longer pre-tokens are counted by themselves and not kept.
LONGEST = 256
ADDED = "n_tokens"
_CUT = re.compile("\n| *[^ \n]+| +")


def zipf_scores(pieces: list[str]) -> dict[str, int]:
    """Millionths of the log probability of each piece, from its place in the list."""
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    scores: dict[str, int] = {}
    for rank, piece in enumerate(pieces):
        # A piece with a space after something else could reach across a cut.
        if piece and SPACE not in piece.lstrip(SPACE) and "\n" not in piece:
            scores.setdefault(piece, round(-1e6 * (math.log(rank + 1) + total)))
    return scores


def load_pieces(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece vocabulary file, most frequent first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [
        at
        for at in range(size)
        if not (model.is_control(at) or model.is_unknown(at) or model.is_byte(at))
    ]
    plain.sort(key=lambda at: (-model.get_score(at), at))
    return [model.id_to_piece(at) for at in plain]


def pretokens_of(marked: str) -> list[str]:
    """The pre-tokens of a text with a space put before it, and spaces for SPACE."""
    return _CUT.findall(marked)


def _width(character: str) -> int:
    return len((SPACE if character == " " else character).encode())


class Trie(dict):
    """Tokens of words, by the forward scores that the words' prefixes share.

    As a dict it has the words' token counts, each counted when it is first asked for; a word is
    what stands between two spaces and starts with an implicit one. In here SPACE is a space again,
    which keeps words of ASCII characters in one byte each.
    """

    def __init__(self, scores: dict[str, int]):
        super().__init__()
        scores = {piece.replace(SPACE, " "): score for piece, score in scores.items()}
        self.scores = scores
        # A byte is less likely than every piece.
        self.byte = min(scores.values(), default=0) - 10_000_000
        # The longest piece that ends with a character bounds how far back to look from it.
        self.reach: dict[str, int] = {}
        self.pieces = {piece: (score << TOKEN_BITS) - 1 for piece, score in scores.items()}
        # The lengths of the pieces that end with two characters, shortest first.
        self.lengths: dict[str, list[int]] = {}
        for piece in sorted(scores, key=len):
            self.reach[piece[-1]] = max(len(piece), self.reach.get(piece[-1], 0))
            if len(piece) > 1:
                known = self.lengths.setdefault(piece[-2:], [])
                if len(piece) not in known:
                    known.append(len(piece))
        # Counts of words that start a line; those of all others are the dict's own.
        self.lines: dict[str, int] = {}
        self.held = 0
        self.forget()

    def forget(self) -> None:
        """Starts the nodes anew. The words' counts stay."""
        self.forward = {"": 0}

    def __missing__(self, word: str) -> int:
        if "\n" in word:
            first, *lines = word.split("\n")
            return self[first] + len(lines) * self.insert("\n") + sum(map(self.line, filter(None, lines)))
        if len(word) > LONGEST:
            return self.insert(" " + word)
        self.held += 4 * len(word) + OF_WORD
        if self.held > WORD_BYTES:
            self.clear()
            self.lines.clear()
            self.held = 0
        found = self[word] = self.insert(" " + word)
        return found

    def line(self, word: str) -> int:
        """Tokens of a word that starts a line, and so without SPACE."""
        found = self.lines.get(word)
        if found is None:
            found = self.insert(word)
            if len(word) <= LONGEST:
                self.held += 4 * len(word) + OF_WORD
                self.lines[word] = found
        return found

    def insert(self, word: str) -> int:
        """Tokens of the pre-token ``word``, whose nodes are added where they are missing."""
        if len(word) > LONGEST:
            return self.alone(word)
        if len(self.forward) > NODES:
            self.forget()
        forward, pieces, lengths = self.forward, self.pieces, self.lengths
        known = len(word)
        while (value := forward.get(word[:known])) is None:
            known -= 1
        for end in range(known + 1, len(word) + 1):
            character = word[end - 1]
            one = pieces.get(character)
            # Where a character is a piece, its bytes are less likely.
            value += self.bytes_of(character) if one is None else one
            for length in lengths.get(word[end - 2 : end], ()):
                if length > end:
                    break
                piece = pieces.get(word[end - length : end])
                if piece is not None:
                    piece += forward[word[: end - length]]
                    if piece > value:
                        value = piece
            forward[word[:end]] = value
        return -value & TOKENS

    def bytes_of(self, character: str) -> int:
        width = _width(character)
        return width * (self.byte << TOKEN_BITS) - width

    def alone(self, word: str) -> int:
        """A very long pre-token, of which only as many prefixes are kept as a piece reaches."""
        keep = max(self.reach.values(), default=0) + 1
        best, tokens = [0], [0]
        for end, character in enumerate(word, 1):
            width = _width(character)
            found = (best[-1] + width * self.byte, -tokens[-1] - width)
            for start in range(max(0, end - self.reach.get(character, 0)), end):
                score = self.scores.get(word[start:end])
                if score is not None:
                    found = max(found, (best[start - end] + score, -tokens[start - end] - 1))
            best.append(found[0])
            tokens.append(-found[1])
            if len(best) > keep:
                del best[0], tokens[0]
        return tokens[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if text[0] == " " or "  " in text or SPACE in text:
            return sum(map(self.insert, pretokens_of(" " + text.replace(SPACE, " "))))
        return sum(map(self.__getitem__, text.split(" ")))


def count_tokens(docs: DataFrame, scores: dict[str, int], text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens``.

    Nothing is shuffled: a task keeps the trie of the words it has met, up to NODES nodes, and the
    counts of whole words, up to WORD_BYTES, whatever the length of a text.
    ``scores`` go to the executors; a vocabulary is bounded by its file.
    """
    rows = without(docs, ADDED)
    kept = [f for f in rows.schema.fields if f.name != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(scores)
        for batch in batches:
            tokens = []
            for value in batch.column(len(kept)):
                tokens.append(trie.count(value.as_py()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(tokens, pa.int64())],
                [*(f.name for f in kept), ADDED],
            )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return rows.select(*[f.name for f in kept], text).mapInArrow(
        count, f"{kinds}n_tokens bigint"
    )
