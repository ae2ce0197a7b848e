"""Token counts by a compiled finite-state transducer (operator 6).

The vocabulary (sentencepiece BPE with byte fallback) becomes a deterministic transducer over characters
whose transitions carry the number of tokens they add. A state holds what later characters can still depend
on: the longest suffix that begins some piece and, for each place inside it where a piece may start, the last
token of the text up to there and how many tokens that text has less than all read so far. A character closes
exactly one piece that its left neighbour accepts as a merge result; that gives the count of the longer text.
States and transitions are compiled when first met and kept in a bounded store.

A piece holds the space mark only at its beginning, so the start state is reached again wherever a mark
follows anything else. A chunk of text is a map from the state before it to the state after it and a count.
It is kept as the count and end state for the start state, and the head of the chunk up to the first reset:
for another entry state both runs go through the head side by side until they meet. Maps compose
associatively; the chunks of a long text compose in a tree.

Defined cases: a null text counts as empty (0 tokens); repeated rows each give a row; ties in doc_id never
mix, as chunks meet by row; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.shared import map_batches, small_batches, table

MARK = "▁"
VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of a chunk; longer texts are dealt out as chunks.
CHUNK = 32_768
#: Entries of the transition store and of the store of whole stretches; memory only, never results.
STORED = 300_000
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

Key = tuple[str, tuple[tuple[int, str, int], ...]]
#: Nothing read: a piece may start here, with no left neighbour.
START: Key = ("", ((0, "", 0),))


class State:
    """A state and the transitions compiled so far, each the next state and the tokens it adds."""

    __slots__ = ("key", "moves")

    def __init__(self, key: Key) -> None:
        self.key = key
        self.moves: dict[str, tuple[State, int]] = {}


class PieceCounter:
    """Transducer of one sentencepiece BPE model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece holds the space mark after other characters")
        if model.normalize(" a") != f"{MARK}{MARK}a" or model.normalize("ﬁ") != f"{MARK}ﬁ":
            raise ValueError("only models with identity normalisation and a leading mark are compiled")
        self.begins = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        self.states: dict[Key, State] = {}
        self.stretches: dict[str, int] = {}
        self.accepts = functools.lru_cache(maxsize=STORED)(self._accepts)
        self.reachable = functools.lru_cache(maxsize=None)(self._reachable)

    # -- compilation

    def merged(self, text: str) -> list[str]:
        """Merges of a short string: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _reachable(self, piece: str) -> bool:
        return self.merged(piece) == [piece]

    def _accepts(self, left: str, right: str) -> bool:
        return self.merged(left + right) == [left, right]

    def state(self, key: Key) -> State:
        """The state of a key; one object a key, until the store starts anew."""
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= STORED:
                self.states.clear()
            found = self.states[key] = State(key)
        return found

    def step(self, state: State, char: str) -> tuple[State, int]:
        """The state after a character and the tokens it adds (below 0 where pieces join)."""
        move = state.moves.get(char)
        if move is None:
            move = state.moves[char] = self._compiled(state.key, char)
        return move

    def _compiled(self, key: Key, char: str) -> tuple[State, int]:
        tail, places = key
        added, last = None, ""
        for back, left, before in places:
            piece = tail[len(tail) - back :] + char
            if back == 0 and piece not in self.score:
                added, last = len(char.encode()), char
                break
            if piece in self.score and self.reachable(piece) and (not left or self.accepts(left, piece)):
                added, last = 1 - before, piece
                break
        if added is None:
            raise ValueError(f"no piece closes after {tail!r} with {char!r}")
        kept = [(back + 1, left, before + added) for back, left, before in places if tail[len(tail) - back :] + char in self.begins]
        longest = max((k[0] for k in kept), default=0)
        return self.state(((tail + char)[len(tail) + 1 - longest :], (*kept, (0, last, 0)))), added

    # -- runs

    def run(self, text: str) -> tuple[State, int]:
        """End state and tokens from the start state."""
        state, total = self.state(START), 0
        for char in text:
            move = state.moves.get(char)
            state, added = move if move is not None else self.step(state, char)
            total += added
        return state, total

    def stretch(self, text: str) -> int:
        """Tokens of a stretch that begins at a reset."""
        if (known := self.stretches.get(text)) is None:
            if len(self.stretches) >= STORED:
                self.stretches.clear()
            known = self.run(text)[1]
            if len(text) < 256:
                self.stretches[text] = known
        return known

    def chunk_map(self, marked: str) -> dict:
        """The map of a chunk of marked text, as described at the top; `end` is a state's key."""
        head, *rest = _STRETCH.findall(marked)
        state, total = self.run(head)
        if rest:
            state, last = self.run(rest[-1])
            total += sum(map(self.stretch, rest[:-1])) + last
        return {"head": head, "reset": bool(rest), "total": total, "end": state.key}

    def enter(self, key: Key, chunk: dict) -> tuple[Key, int]:
        """State and count after a chunk that is entered in the state of `key`."""
        own, total, plain, base = self.state(key), 0, self.state(START), 0
        if chunk["head"][0] == MARK and key[1][-1][1].strip(MARK):
            return chunk["end"], chunk["total"]  # a mark after anything else is a reset
        for char in chunk["head"]:
            if own.key == plain.key:
                break
            own, a = self.step(own, char)
            plain, b = self.step(plain, char)
            total, base = total + a, base + b
        if own.key != plain.key and not chunk["reset"]:
            return own.key, total
        return chunk["end"], total + chunk["total"] - base

    def compose(self, first: dict, second: dict) -> dict:
        """The map of two chunks, one after the other."""
        end, total = self.enter(first["end"], second)
        met = first["reset"] or (second["head"][0] == MARK and first["head"][-1] != MARK)
        head = first["head"] if met else first["head"] + second["head"]
        return {"head": head, "reset": met or second["reset"], "total": first["total"] + total, "end": end}

    def composed(self, maps: list[dict]) -> dict:
        """Neighbours composed level by level."""
        while len(maps) > 1:
            maps = [self.compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if MARK in text or "  " in text or text[0] == " ":
            return sum(map(self.stretch, _STRETCH.findall(MARK + text.replace(" ", MARK))))
        return sum(map(self.spaced, text.split(" ")))

    def spaced(self, word: str) -> int:
        return self.stretch(MARK + word)


@functools.lru_cache(maxsize=4)
def piece_counter(path: str) -> PieceCounter:
    """The transducer of a model file, once per Python worker."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK) -> DataFrame:
    """One row per row of `docs`: the columns in `keep`, `n_bytes` (UTF-8) and `n_tokens`."""
    small_batches(docs.sparkSession)
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("__text"), F.octet_length(whole).cast("long").alias("n_bytes"))
    schema = kept + "n_bytes bigint, n_tokens bigint"

    def count(batch: dict[str, list]) -> dict[str, list]:
        counter = piece_counter(vocabulary)
        return {c: batch[c] for c in (*keep, "n_bytes")} | {"n_tokens": [counter.count(t) for t in batch["__text"]]}

    def map_chunk(batch: dict[str, list]) -> dict[str, list]:
        counter = piece_counter(vocabulary)
        maps = [counter.chunk_map(t) for t in batch["__text"]]
        return {c: batch[c] for c in (*keep, "n_bytes", "__row", "__seq")} | {
            "head": [m["head"] for m in maps], "reset": [m["reset"] for m in maps], "total": [m["total"] for m in maps],
            "tail": [m["end"][0] for m in maps], "places": [[{"back": b, "left": w, "before": n} for b, w, n in m["end"][1]] for m in maps],
        }

    def meet(maps: pa.Table) -> pa.Table:
        counter = piece_counter(vocabulary)
        maps = maps.sort_by("__seq")
        ordered = [{"head": m["head"], "reset": m["reset"], "total": m["total"], "end": (m["tail"], tuple((p["back"], p["left"], p["before"]) for p in m["places"]))} for m in maps.to_pylist()]
        first = maps.slice(0, 1)
        return pa.table([*(first[c] for c in (*keep, "n_bytes")), pa.array([counter.composed(ordered)["total"]], pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    short = map_batches(rows.where(F.length("__text") <= chunk), count, schema)
    numbered = rows.withColumn("__row", F.monotonically_increasing_id()).where(F.length("__text") > chunk)
    marked = F.concat(F.lit(MARK), F.translate("__text", " ", MARK))
    cuts = F.sequence(F.lit(0), F.ceil(F.length(marked) / chunk).cast("int") - 1)
    placed = numbered.withColumn("__text", marked).select("*", F.explode(cuts).alias("__seq"))
    chunks = placed.withColumn("__text", F.substring("__text", F.col("__seq") * chunk + 1, F.lit(chunk)))
    chunk_schema = kept + "n_bytes bigint, __row bigint, __seq int, head string, reset boolean, total bigint, tail string, places array<struct<back:int, left:string, before:bigint>>"
    maps = map_batches(chunks.repartition("__row", "__seq"), map_chunk, chunk_schema)
    return short.unionByName(maps.groupBy("__row").applyInArrow(meet, schema))


def op6_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document, and whether they exceed the limit."""
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)


QUERIES = {"op6_piece_counts": op6_piece_counts}
ORACLE: dict[str, str] = {}
