"""Token counts: exact counts at every prefix of a text, by dynamic programming.

The vocabulary is a byte-pair model of whole pieces (sentencepiece, byte fallback). The encoding
of a prefix is the encoding of a shorter prefix and one last piece, so a table of the last piece
at each position determines every encoding: position i takes the piece that ends there and stands
beside the last piece of the position where it starts just as the two are encoded together.

No piece holds a word start (U+2581) behind another character, so merges never cross a word start
that follows one, nor two characters that stand side by side in no piece: a text is a row of
independent parts, the count of a prefix is the sum over its whole parts and the prefix table of
the part it ends in. Tables of parts are kept and reused.

Null and empty texts have no tokens. Very long words only make a longer table. Documents repeat
freely: rows in equal rows out, other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quantarium.llm import arrow_text
from quantarium.session import ship_package

MARK = "▁"
#: Words whose totals a worker holds in each of two generations.
HELD_WORDS = 500_000
#: A longer word is not held.
HELD_LENGTH = 64
#: Prefixes of parts whose states a worker holds in each of two generations.
HELD_STATES = 900_000


class PieceVocabulary:
    """Pieces with ranks (lower merges first) of a sentencepiece model file of type BPE."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_byte, model.is_unknown, model.is_unused)
        self.ranks: dict[str, float] = {
            model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size()) if not any(f(i) for f in special)
        }
        self.longest = max(map(len, self.ranks))
        self.pairs = {a + b for p in self.ranks for a, b in zip(p, p[1:])}
        if any(MARK in p.lstrip(MARK) for p in self.ranks):
            raise ValueError("a piece holds a word start behind another character")
        # the model's own treatment of the start of a text and of plain characters is checked, not assumed
        if model.encode("a", out_type=str) != [MARK + "a"] or model.encode("  a", out_type=str)[0][0] != MARK:
            raise ValueError("a model that starts a text with one word start is expected")
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.reach: dict[str, int] = {}
        for p in self.ranks:
            if len(p) > 1:
                self.reach[p[-2:]] = max(self.reach.get(p[-2:], 1), len(p))
        if self.longest > 31:
            raise ValueError("pieces of at most 31 characters are expected")
        self.joins = lru_cache(maxsize=500_000)(self._joins)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging: the lowest rank first, the leftmost of equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min(((self.ranks.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))))
            if best[0] == float("inf"):
                break
            i = best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def _joins(self, left: str, right: str) -> bool:
        return self.merge([*left, *right]) == [left, right]

    def size(self, piece: str) -> int:
        """Tokens of a final piece: one, or the bytes of an unknown character."""
        return 1 if piece in self.ranks else len(piece.encode())

    def state(self, word: str) -> int:
        """Tokens of the word; states of its prefixes are held and shared with other words.

        A state is tokens * 32 + characters of the last piece. Two generations are held, each closed
        under prefixes: a full one becomes the old one, and what is met again moves to the new one.
        """
        new, n = self.new, len(word)
        known = n
        while known and word[:known] not in new:
            known -= 1
        if known == n:
            return new[word] >> 5
        if len(new) > HELD_STATES:
            self.old, self.new = new, {}
            new, known = self.new, 0
        old, ranks, reach, joins = self.old.get, self.ranks, self.reach, self.joins
        i = known + 1
        while i <= n and (held := old(word[:i])) is not None:
            new[word[:i]] = held
            i += 1
        for i in range(i, n + 1):
            for size in range(min(i, reach.get(word[i - 2 : i], 1) if i > 1 else 1), 0, -1):
                piece = word[i - size : i]
                if size == 1 or piece in ranks:
                    if size == i:
                        if self._alone(piece):
                            new[piece] = self.size(piece) << 5 | size
                            break
                    else:
                        before = new[word[: i - size]]
                        if joins(word[i - size - (before & 31) : i - size], piece):
                            new[word[:i]] = ((before >> 5) + (1 if piece in ranks else self.size(piece))) << 5 | size
                            break
        return new[word] >> 5

    def table(self, word: str) -> tuple[int, ...]:
        """Token counts of word[:1], word[:2], ... word."""
        if len(word) <= HELD_LENGTH:
            self.state(word)
            return tuple(self.new[word[:i]] >> 5 for i in range(1, len(word) + 1))
        return self._long_table(word)

    def _long_table(self, word: str) -> tuple[int, ...]:
        """The same for a word too long to keep its prefixes."""
        last: list[str] = [""]
        counts = [0]
        for i in range(1, len(word) + 1):
            for k in range(max(0, i - self.longest), i):
                piece = word[k:i]
                if (piece in self.ranks or k == i - 1) and (self._alone(piece) if k == 0 else self.joins(last[k], piece)):
                    last.append(piece)
                    counts.append(counts[k] + self.size(piece))
                    break
        return tuple(counts[1:])

    @lru_cache(maxsize=100_000)  # noqa: B019  one vocabulary a worker
    def _alone(self, piece: str) -> bool:
        return len(piece) == 1 or self.merge([*piece]) == [piece]


class PrefixCounter:
    """Answers count, truncation and budget questions about texts without encoding them again.

    A word is cut further where its two characters stand side by side in no piece; the words'
    totals are held.
    """

    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary = vocabulary
        self.totals: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _size(self, part: str) -> int:
        return self.vocabulary.state(part) if len(part) <= HELD_LENGTH else self.vocabulary.table(part)[-1]

    def _parts(self, word: str) -> list[str]:
        pairs = self.vocabulary.pairs
        cuts = [i for i, (a, b) in enumerate(zip(word, word[1:]), 1) if a + b not in pairs]
        if not cuts:
            return [word]
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])]

    def _total(self, word: str) -> int:
        total = self.old.get(word)
        if total is None:
            total = sum(map(self._size, self._parts(word)))
        if len(word) <= HELD_LENGTH:
            if len(self.totals) >= HELD_WORDS:
                self.old, self.totals = self.totals, {}
            self.totals[word] = total
        return total

    @staticmethod
    def words(text: str) -> list[str]:
        """The text with its leading word start, cut before each word start that follows another character."""
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return [MARK + p for p in parts]
        out, marks = [], ""
        for p in parts:
            marks += MARK
            if p:
                out.append(marks + p)
                marks = ""
        return [*out, marks] if marks else out

    def total(self, text: str) -> int:
        if not text:
            return 0
        words = self.words(text)
        try:
            return sum(map(self.totals.__getitem__, words))
        except KeyError:
            held = self.totals.get
            return sum(n if (n := held(w)) is not None else self._total(w) for w in words)

    def fits(self, text: str, budget: int) -> int:
        """PrefixTable.fits of the text, with tables only for the words where the budget may run out."""
        before = start = 0
        held = self.totals.get
        for w in self.words(text):
            if before + 4 * len(w) > budget:  # a prefix has at most a token a byte
                sums = 0
                place = start
                for part in self._parts(w):
                    for c in (table := self.vocabulary.table(part)):
                        if before + sums + c > budget:
                            return max(place - 1, 0)
                        place += 1
                    sums += table[-1]
            before += n if (n := held(w)) is not None else self._total(w)
            start += len(w)
        return len(text)

    def prefix_table(self, text: str) -> PrefixTable:
        words = self.words(text) if text else []
        return PrefixTable([self.vocabulary.table(p) for w in words for p in self._parts(w)])


class PrefixTable:
    """Token counts at every prefix of one text; position i is the prefix of i characters."""

    def __init__(self, tables: list[tuple[int, ...]]):
        self.tables = tables
        self.ends = list(accumulate(map(len, tables)))
        self.sums = list(accumulate((t[-1] for t in tables)))

    def __len__(self) -> int:
        return self.ends[-1] - 1 if self.ends else 0

    def count(self, prefix: int) -> int:
        """Tokens of the first `prefix` characters, as if encoded alone."""
        if prefix <= 0 or not self.tables:
            return 0
        at = min(prefix, len(self)) + 1  # the leading word start
        w = bisect_right(self.ends, at - 1)
        before, start = (self.sums[w - 1], self.ends[w - 1]) if w else (0, 0)
        return before + self.tables[w][at - start - 1]

    def fits(self, budget: int) -> int:
        """The longest prefix whose every shorter prefix and itself have at most budget tokens."""
        w = bisect_right(self.sums, budget)
        w -= w == len(self.sums)
        best = 0
        for i in range(max(w - 1, 0), len(self.tables)):
            before, start = (self.sums[i - 1], self.ends[i - 1]) if i else (0, 0)
            for j, c in enumerate(self.tables[i]):
                if before + c > budget:
                    return max(best, start + j - 1, 0)
                best = max(best, start + j)
        return len(self)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(PieceVocabulary(path))


def token_counts(documents: DataFrame, model_path: str, budget: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit and fit_chars (characters that fit the budget) of each row."""
    ship_package(documents.sparkSession)

    def count(batches):
        c = counter(model_path)
        for batch in batches:
            texts = batch.column(1)
            offsets, _ = arrow_text.buffers(texts)
            tokens, fit = [], []
            for x in texts.to_pylist():
                n = c.total(x or "")
                tokens.append(n)
                fit.append(len(x or "") if n <= budget else c.fits(x, budget))
            t = np.array(tokens, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(t), pa.array(t > budget), pa.array(fit, pa.int64())],
                ["id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(documents[id_col].alias("id"), documents[text_col].alias("text"))
    out = rows.mapInArrow(arrow_text.tidied(count), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
    return out.withColumnRenamed("id", id_col)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
