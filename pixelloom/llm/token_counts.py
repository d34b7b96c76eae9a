"""Token counts without token ids: pieces are counted once for each distinct pre-token and joined to the frequencies of each document."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm.common import materialise

#: Documents of the sample that the common pre-tokens are taken from, and most of these; both bear on speed alone, as a
#: pre-token that isn't among them is counted and joined by shuffles.
SAMPLE_TEXTS, COMMON = 20_000, 400_000
#: Common pre-tokens are at most so many characters long, which bounds the table that every task holds.
COMMON_CHARS = 48

# Fixed value: the pattern by which byte-level tokenizers split a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PreTokens:
    """Splits texts as a tokenizers file does, and counts the tokens of a pre-token.

    A byte-level file without a normaliser is split by its pattern with the regex library, which is five times as fast;
    every character is first compared in both, and a text with one that they class differently goes to the file's own
    splitter. Other files are split by their own normaliser and pre-tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder().values()
        for a in added:
            if a.lstrip or a.rstrip or a.single_word or a.normalized and self.tok.normalizer is not None:
                raise ValueError(f"added token {a.content!r} takes in text around it")
        names = sorted((a.content for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        if self.tok.pre_tokenizer is None:
            raise ValueError("a file without pre-tokenizer has no pre-tokens")
        own = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.fast = self.tok.normalizer is None and self.tok.pre_tokenizer.__getstate__() == own.__getstate__()
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.find = regex.compile(BYTE_LEVEL).findall
        self.same: dict[str, bool] = {}

    def alike(self, c: str) -> bool:
        """Whether the regex library and the file's splitter class a character alike."""
        found = self.same.get(c)
        if found is None:
            probes = [a + c for a in "a1! "]
            found = self.same[c] = all(len(self.find(x)) == len(self.tok.pre_tokenizer.pre_tokenize_str(x)) for x in probes)
        return found

    def parts(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        split = self.tok.pre_tokenizer.pre_tokenize_str
        if not self.fast:
            return [p for p, _ in split(self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text)]
        if all(map(self.alike, set(text))):
            return self.find(text)
        return [text[a:b] for _, (a, b) in split(text)]

    def frequencies(self, text: str) -> tuple[int, Counter]:
        """The number of special strings in a text, and how often each pre-token occurs between them."""
        if self.special is None or not (specials := self.special.findall(text)):
            return 0, Counter(self.parts(text))
        found: Counter = Counter()
        for part in self.special.split(text):
            found.update(self.parts(part))
        return len(specials), found

    def pieces(self, pre_token: str) -> int:
        """Tokens of a pre-token."""
        mapped = self.bytes.pre_tokenize_str(pre_token) if self.fast else [(pre_token, None)]
        return sum(len(self.tok.model.tokenize(m)) for m, _ in mapped)


_loaded: dict[str, PreTokens] = {}


def _pre_tokens(path: str) -> PreTokens:
    """Once for each worker process."""
    if path not in _loaded:
        _loaded[path] = PreTokens(path)
    return _loaded[path]


def pieces_of(pre_tokens: DataFrame, path: str) -> DataFrame:
    """(piece, m): the tokens m of each row's pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count = _pre_tokens(path).pieces
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([count(p) for p in b.column(0).to_pylist()], pa.int64())], names=["piece", "m"])

    return pre_tokens.select("piece").mapInArrow(run, "piece string, m long")


def common_pieces(texts: DataFrame, path: str) -> dict[str, int]:
    """Tokens of the pre-tokens most frequent in a bounded sample of the column raw, which is chosen by a hash."""
    n = texts.count()
    share = int(1_000_000 * min(1.0, SAMPLE_TEXTS / max(1, n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for raw in b.column(0).to_pylist():
                for p, k in _pre_tokens(path).frequencies((raw or b"").decode("utf-8", "replace"))[1].items():
                    found[p] += k
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["piece", "n"])

    some = texts.where(F.pmod(F.xxhash64("raw"), F.lit(1_000_000)) < share)
    counts = some.mapInArrow(run, "piece string, n long").where(F.length("piece") <= COMMON_CHARS).groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1")
    best = counts.orderBy(F.desc("n"), "piece").limit(COMMON)
    got = pieces_of(best, path).toArrow()
    return dict(zip(got.column("piece").to_pylist(), got.column("m").to_pylist(), strict=True))


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every input row: tokens as the tokenizers file at path gives them, whose path every executor must have.

    No begin or end tokens are added, nothing is cut or padded; special strings inside a text are one token each, as is
    the library's default. Each text is split once into pre-tokens with their frequencies. The tokens of a common pre-token
    are counted before, once, and every task holds that table, of at most COMMON rows; the other pre-tokens are made
    distinct, counted once each and joined to the documents' frequencies by shuffles. No ids are made.

    Null and empty texts have no bytes and no tokens; very long texts are counted whole; repeated rows and null ids each
    keep their row; an empty table gives no rows. Columns besides id and text are ignored, whatever their names.
    """
    if not path.endswith(".json"):
        raise ValueError("a .json file of the tokenizers library is needed: others have no pre-tokens")
    spark: SparkSession = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    known = spark.sparkContext.broadcast(common_pieces(rows.select("raw"), path))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = known.value
        for b in batches:
            sizes, sums, rest, times = [], [], [], []
            for raw in b.column(2).to_pylist():
                special, found = _pre_tokens(path).frequencies((raw or b"").decode("utf-8", "replace"))
                rare = [p for p in found if p not in common]
                rest.append(rare)
                times.append([found.pop(p) for p in rare])
                sizes.append(len(raw or b""))
                sums.append(special + sum(common[p] * k for p, k in found.items()))
            arrays = [pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], names=["row", "doc_id", "n_bytes", "n", "piece", "times"])

    done = materialise(rows.mapInArrow(split, f"row long, doc_id {kind}, n_bytes long, n long, piece array<string>, times array<long>"), "frequencies")
    rest = done.select("row", F.explode(F.arrays_zip("piece", "times")).alias("p")).select("row", "p.piece", "p.times")
    counted = materialise(pieces_of(rest.select("piece").distinct(), path), "pieces")
    more = rest.join(counted, "piece").select("row", (F.col("times") * F.col("m")).alias("n"))
    whole = done.select("row", F.struct("doc_id", "n_bytes").alias("own"), "n").unionByName(more.select("row", F.lit(None).cast(f"struct<doc_id:{kind},n_bytes:bigint>").alias("own"), "n"))
    summed = whole.groupBy("row").agg(F.first("own", ignorenulls=True).alias("own"), F.sum("n").alias("n_tokens"))
    return summed.select("own.doc_id", "own.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
