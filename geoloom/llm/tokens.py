"""Token counts by heap-and-linked-list byte-pair merging.

A text's symbols form a doubly linked list; adjacent pairs whose concatenation
is a piece wait in a heap ordered by rank and position. Popping the best pair
merges it and offers its two new neighbours. The count is the number of first
symbols minus the merges, plus the extra bytes of symbols that no piece covers;
identifiers are never made.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import per_row, table

SPACE = "▁"


def load_pieces(path: str) -> dict[str, int]:
    """Ranks of the mergeable pieces of a sentencepiece BPE model: best score first.

    Pieces of equal score share a rank; among those the leftmost pair is merged first.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    normal = [(p.piece, p.score) for p in model.pieces if p.type in (1, 4, 5)]
    order = {s: k for k, s in enumerate(sorted({s for _, s in normal}, reverse=True))}
    return {piece: order[score] for piece, score in normal}


def merge_count(symbols: str, ranks: dict[str, int]) -> int:
    """Tokens of one stretch of symbols; spaces are written as the piece's space sign."""
    n = len(symbols)
    if n == 0:
        return 0
    piece = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    get = ranks.get
    heap = []
    for i in range(n - 1):
        pair = piece[i] + piece[i + 1]
        if (rank := get(pair)) is not None:
            heap.append((rank, i, i + 1, pair))
    heapify(heap)
    merges = 0
    while heap:
        _, i, j, pair = heappop(heap)
        if piece[i] is None or piece[j] is None or after[i] != j or len(piece[i]) + len(piece[j]) != len(pair):
            continue
        piece[i], piece[j] = pair, None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            longer = pair + piece[k]
            if (rank := get(longer)) is not None:
                heappush(heap, (rank, i, k, longer))
        if (h := before[i]) >= 0:
            longer = piece[h] + pair
            if (rank := get(longer)) is not None:
                heappush(heap, (rank, h, i, longer))
    spelled = sum(len(p.encode("utf-8", "surrogatepass")) - 1 for p in piece if p is not None and p not in ranks)
    return n - merges + spelled


class Counter(dict):
    """Counts whole texts. Stretches that no piece can cross are counted apart and remembered.

    The memory of stretches is bounded: it is emptied when `remembered` are held,
    and stretches of over `longest` symbols aren't kept. That changes no count.
    """

    def __init__(self, ranks: dict[str, int], remembered: int = 300_000, longest: int = 48):
        super().__init__()
        self.ranks, self.remembered, self.longest = ranks, remembered, longest
        inner = set("".join(p for p in ranks if len(p) > 1))
        if any(SPACE in p.lstrip(SPACE) for p in ranks):
            self.stretch = re.compile(r"(?s).+")
        elif "\n" in inner:
            self.stretch = re.compile(r" *[^ ]+| +")
        else:
            self.stretch = re.compile(r" *[^ \n]+| +|\n")

    def __missing__(self, stretch: str) -> int:
        n = merge_count(stretch.replace(" ", SPACE), self.ranks)
        if len(stretch) <= self.longest:
            if len(self) >= self.remembered:
                self.clear()
            self[stretch] = n
        return n

    def count(self, text: str | None) -> int:
        """Tokens of the text as the model gives them, with its leading space; 0 for null or empty."""
        if not text:
            return 0
        return sum(map(self.__getitem__, self.stretch.findall(" " + text.replace(SPACE, " "))))


def count_tokens(docs: DataFrame, model: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Adds `out`: the number of tokens of `text` under the sentencepiece BPE model at `model`.

    Each row is counted by itself over its whole text: null and empty texts have
    0 tokens, repeated rows stay and get the same count, an empty table stays
    empty, and a column already named `out` is replaced. Memory is one batch of
    rows plus the bounded memory of stretches. No shuffle.
    """
    share = docs.sparkSession.sparkContext.broadcast(load_pieces(model))  # as many entries as the vocabulary file

    def start():
        counter = Counter(share.value)
        return lambda texts: [pa.array([counter.count(t.as_py()) for t in texts], pa.int64())]

    return per_row(docs, text, {out: "bigint"}, start)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model; over_limit marks more than 4096."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )
