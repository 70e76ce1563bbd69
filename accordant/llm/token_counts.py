"""Exact token counts by composing the state maps of text chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm import bpe
from accordant.llm.text import map_rows

#: Characters of a chunk.
CHUNK = 1 << 12

#: The map of a chunk of text, whatever state it is entered in: what stands before its first cut (the
#: rest of a symbol begun earlier), the tokens emitted between its first and last cut, and what stands
#: after its last cut. A chunk without a cut has only a head.
StateMap = tuple[str, int, str | None]


def state_map(chunk: str, counts: dict) -> StateMap:
    head, *rest = bpe.symbols(chunk)
    if not rest:
        return chunk, 0, None
    tail = rest.pop()
    return head, sum(map(counts.__getitem__, rest)), tail


def compose(a: StateMap, b: StateMap, count) -> StateMap:
    """The map of ``a`` followed by ``b``; associative. ``count`` gives the tokens of an inner symbol.

    The seam is cut again: a space at the edge of a chunk becomes a cut once both of its neighbours are
    known.
    """
    seam = bpe.CUT.split((a[0] if a[2] is None else a[2]) + b[0])
    symbols = ([] if a[2] is None else [a[0]]) + seam + ([] if b[2] is None else [b[2]])
    total = a[1] + b[1]
    if len(symbols) == 1:
        return symbols[0], total, None
    return symbols[0], total + sum(count(s) for s in symbols[1:-1]), symbols[-1]


def prefix_scan(maps: list[StateMap], count) -> list[StateMap]:
    """Composition of every prefix of ``maps``, by doubling strides: any split of the work gives the same."""
    out, stride = list(maps), 1
    while stride < len(out):
        out = [out[i] if i < stride else compose(out[i - stride], out[i], count) for i in range(len(out))]
        stride *= 2
    return out


def total(m: StateMap, start, count) -> int:
    """Tokens of a text with map ``m``, entered in the start state."""
    return (start(m[0]) if m[0] else 0) + m[1] + (count(m[2]) if m[2] is not None else 0)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 chunk: int = CHUNK, max_tokens: int = 512) -> DataFrame:
    """(``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``) for every row of ``docs``.

    Null and empty texts have 0 of each. The special string inside a text is one token, and the text on
    either side of it is counted on its own, as the tokenizer library does by default. Repeated rows are
    counted each. ``path`` is a byte-level BPE tokenizer file present on every worker; texts are counted by
    chunks of ``chunk`` characters.
    """
    file = path or bpe.default_path()

    def make():
        fst = bpe.Transducer(file, bpe.count_of)
        inner = fst.__getitem__

        def tokens(part: str) -> int:
            maps = [state_map(part[i : i + chunk], fst) for i in range(0, len(part), chunk)]
            return total(prefix_scan(maps, inner)[-1], fst.start, inner) if maps else 0

        def step(ids, texts):
            pieces = [(t or "").split(bpe.SPECIAL) for t in texts]
            n = [len(parts) - 1 + sum(map(tokens, parts)) for parts in pieces]
            return ids, [len((t or "").encode()) for t in texts], n, [x > max_tokens for x in n]

        return step

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make,
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
