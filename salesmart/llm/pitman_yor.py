"""Operator 13: a hierarchical Pitman-Yor language model, seated by Gibbs sampling.

A word follows its context, the word before it. Each context is a restaurant whose customers are
the words seen after it; its tables are customers of the parent that all contexts share, the root,
whose tables draw words evenly. The state is, for every pair (context, word), how many customers
and tables there are.

Pairs are dealt to parts by a hash of the pair, so no context, however frequent, lies in one task.
A part seats its pairs; then the parts send their sums per word to the root's parts (words dealt by
hash) and get back what they need of the root and of their contexts. Words travel as sorted arrays of 64-bit hashes,
many to a row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, mix


@dataclass(frozen=True)
class Model:
    rounds: int = 3  # exchanges with the root; every one but the first gives a sample
    sweeps: int = 2  # Gibbs sweeps over all pairs between two exchanges
    strength: float = 1.0  # of contexts and root
    seed: int = 1


#: Tokens of a batch of texts; bytes of text for each part.
BATCH_TOKENS = 2_000_000
PART_BYTES, LEAST_PARTS = 8 << 20, 32
#: Bytes of text that are split at once.
_SPLIT_BYTES = 2 << 20
#: Pairs of more customers seat this many exactly, the rest in growing blocks.
EXACT = 200
_WORK = 1_000_000
#: No word is or holds white space.
_START, _END = b" ", b"  "

_POST = "batch long, part int, digest long, words binary, context binary, word binary, count binary"
_STATE = (
    "part int, words binary, context binary, word binary, count binary, "
    "batches array<long>, digests array<long>, places array<binary>"
)
_UP = "root int, part int, words binary, sums array<binary>"
_DOWN = (
    "part int, root int, round int, sums array<binary>, "
    "tokens long, distinct long, customers long, tables long, ones long, twos long"
)
_REPLY = "batch long, part int, digest long, first binary, second binary, third binary"
_SCORE = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def _pack(values: np.ndarray) -> bytes:
    if values.dtype.kind != "f":
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    return values.dtype.char.encode() + zstandard.compress(values.tobytes(), 1)


def _unpack(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob[1:]), blob[:1].decode()).astype(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.cumsum(_unpack(blob, kind), dtype=kind)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for integers faster than `np.unique`."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0]


def _schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
        "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _rows(rows: list[tuple], ddl: str) -> pa.Table:
    schema = _schema(ddl)
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


# --- batches of texts ---------------------------------------------------------------------


class _Numbers(dict):
    def __init__(self):
        super().__init__({_START: 0, _END: 1})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Batch:
    """Some texts, their distinct pairs by part, context and word, and each token's pair."""

    def __init__(self, number: int, docs: list[tuple], ids: list[list[int]], words: _Numbers, parts: int):
        self.number, self.docs = number, docs
        self.lengths = np.array([len(x) for x in ids], np.int64)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        # words are numbered anew by their hash: what is sorted by number is sorted by hash
        self.hashes, rank = np.unique(hashes, return_inverse=True)
        word = rank[np.concatenate(ids)]
        self.starts = np.cumsum(self.lengths) - self.lengths
        pairs = np.concatenate((rank[:1], word[:-1]))
        pairs[self.starts] = rank[0]
        pairs <<= 32
        pairs |= word
        del word  # a task's memory is what these arrays take at once
        order = np.argsort(pairs)
        pairs = pairs[order]
        new = np.ones(len(pairs), bool)
        np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
        pair = np.empty(len(pairs), np.int32)
        pair[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        pairs = pairs[new]
        left, right = (pairs >> 32).astype(np.int32), pairs.astype(np.int32)
        del order, pairs
        part = mix(mix(self.hashes)[left] + self.hashes[right]) % np.uint64(parts)
        part = part.astype(np.min_scalar_type(parts))  # the stable sort of short integers is by digits
        order = np.argsort(part, kind="stable")
        self.left, self.right = left[order], right[order]
        self.cuts = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.pair = place[pair]

    def digests(self) -> list[int]:
        """Per part, a digest of the pairs in their order."""
        left, right = self.hashes[self.left], self.hashes[self.right]
        both = zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist(), strict=True)
        out = [
            xxhash.xxh3_64_intdigest(left[a:b].tobytes() + right[a:b].tobytes())
            for a, b in both
        ]
        return np.array(out, np.uint64).view(np.int64).tolist()

    def posts(self) -> list[tuple]:
        """For each part its pairs, with how often the texts that teach have each."""
        teaches = np.repeat([not held for _, held in self.docs], self.lengths)
        count = np.bincount(self.pair[teaches], minlength=len(self.left))
        at = np.empty(len(self.hashes), np.int64)
        out = []
        for part, digest in enumerate(self.digests()):
            a, b = self.cuts[part], self.cuts[part + 1]
            if a == b:
                continue
            left, right = self.left[a:b], self.right[a:b]
            words = _distinct(np.concatenate((left, right)))
            at[words] = np.arange(len(words))
            out.append(
                (
                    self.number,
                    part,
                    digest,
                    _pack_sorted(self.hashes[words]),
                    _pack_sorted(at[left]),
                    _pack(at[right]),
                    _pack(count[a:b]),
                )
            )
        return out

    def asked(self) -> tuple:
        """The texts as the sorted numbers of their pairs."""
        pair = np.repeat(np.arange(len(self.lengths), dtype=np.int64) << 32, self.lengths)
        pair |= self.pair
        pair.sort()
        pair &= 0xFFFFFFFF
        step = np.diff(pair, prepend=0)
        step[self.starts] = pair[self.starts]
        ids = pa.array([i for i, _ in self.docs], pa.int64())
        held = pa.array([h for _, h in self.docs], pa.bool_())
        sink = pa.BufferOutputStream()
        digests = pa.array(self.digests(), pa.int64())
        with pa.ipc.new_stream(sink, pa.schema([("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("digests", pa.list_(pa.int64()))])) as out:
            out.write_batch(
                pa.record_batch([pa.array([x.to_pylist()], pa.list_(x.type)) for x in (ids, held, digests)], ["docs", "held", "digests"])
            )
        return (self.number, -1, 0, _pack(step), _pack(self.lengths), sink.getvalue().to_pybytes())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.binary_length(batch.column(2)).fill_null(0).to_numpy().cumsum(dtype=np.int64)
        cuts = [*np.flatnonzero(np.diff(size // _SPLIT_BYTES, prepend=-1)).tolist(), len(size)]
        for a, b in itertools.pairwise(cuts):
            yield batch.slice(a, b - a)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts after lower-casing A-Z, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # a text that begins or ends with space
    owner = pc.list_parent_indices(lists).filter(some)
    return words.filter(some), np.bincount(owner.to_numpy(), minlength=len(texts))


def _numbered(found: pa.Array, lengths: np.ndarray, words: _Numbers) -> list[np.ndarray]:
    """The numbers of each text's words and end."""
    coded = found.dictionary_encode()
    own = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    own = np.fromiter(map(words.__getitem__, own), np.int32, len(own))
    ends = np.cumsum(lengths + 1)
    out = np.full(len(found) + len(lengths), words[_END], np.int32)
    is_word = np.ones(len(out), bool)
    is_word[ends - 1] = False
    out[is_word] = own[coded.indices.to_numpy()]
    return np.split(out, ends[:-1])


def _read_batches(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[_Batch]:
    """The texts of a partition in batches whose numbers a repeated task gives again."""
    number = TaskContext.get().partitionId() << 24
    docs, ids, words, tokens = [], [], _Numbers(), 0
    for some in _slices(batches):
        rows = list(zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True))
        found, lengths = _split(some.column(2))
        while rows:
            grown = tokens + np.cumsum(lengths + 1)
            n = min(len(rows), int(np.searchsorted(grown, BATCH_TOKENS)) + 1)
            here, tokens = int(lengths[:n].sum()), int(grown[n - 1])
            docs += rows[:n]
            ids += _numbered(found[:here], lengths[:n], words)
            rows, found, lengths = rows[n:], found[here:], lengths[n:]
            if tokens >= BATCH_TOKENS:
                full = _Batch(number, docs, ids, words, parts)
                number += 1
                docs, ids, words, tokens = [], [], _Numbers(), 0
                yield full
                del full
    if docs:
        yield _Batch(number, docs, ids, words, parts)


def _posts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read_batches(parts, batches):
            for post in batch.posts():
                yield from _rows([post], _POST).to_batches()

    return run


def _asked(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read_batches(parts, batches):
            yield from _rows([batch.asked()], _REPLY).to_batches()

    return run


# --- parts --------------------------------------------------------------------------------


def _gather(table: pa.Table) -> pa.Table:
    """The pairs of all batches as those of one part."""
    rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
    lists = [_unpack_sorted(r["words"], np.uint64) for r in rows]
    words = _distinct(np.concatenate(lists))
    codes = []
    for r, own in zip(rows, lists, strict=True):
        at = np.searchsorted(words, own)
        codes.append(at[_unpack_sorted(r["context"])] << 32 | at[_unpack(r["word"])])
    pairs = _distinct(np.concatenate(codes))
    count, places = np.zeros(len(pairs), np.int64), []
    for r, own in zip(rows, codes, strict=True):
        at = np.searchsorted(pairs, own)  # the pairs of a batch are distinct
        count[at] += _unpack(r["count"])
        places.append(_pack_sorted(at))
    row = (
        rows[0]["part"],
        _pack_sorted(words),
        _pack_sorted(pairs >> 32),
        _pack(pairs & 0xFFFFFFFF),
        _pack(count),
        [r["batch"] for r in rows],
        [r["digest"] for r in rows],
        places,
    )
    return _rows([row], _STATE)


@dataclass(frozen=True)
class _Totals:
    """What the whole corpus has, after one exchange."""

    tokens: int = 0
    distinct: int = 0
    customers: int = 0
    tables: int = 0
    ones: int = 0  # words with one customer at the root, and with two
    twos: int = 0


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def _log_stirling(discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: ways to seat n customers at m tables, each
    weighted by what the tables' sizes give."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    tables = np.arange(EXACT + 1)
    for n in range(EXACT):
        with np.errstate(divide="ignore"):
            joined = out[n] + np.log(np.maximum(n - discount * tables, 0.0))
        opened = np.concatenate(([-np.inf], out[n, :-1]))
        out[n + 1] = np.logaddexp(joined, opened)
    return out


def draw_tables(
    count: np.ndarray,
    others: np.ndarray,
    prior: np.ndarray,
    discount: float,
    strength: float,
    rng: np.random.Generator,
) -> np.ndarray:
    """One Gibbs step for many dishes at once: the customers of a dish rise and sit down again.

    `count` customers have the dish, `others` tables of the restaurant serve other dishes, the
    parent serves the dish with probability `prior`. The number of tables is drawn from its
    conditional distribution, with the ways to seat the customers summed up. Dishes of more than
    `EXACT` customers seat so many in this way, the rest in turn, in blocks of a sixteenth of those
    who sit. As every table makes it less likely, by the power -discount of the growth, that all who come
    later have the dish too, tables are weighed by that power.
    """
    tables = (count > 0).astype(np.int64)
    stirling = _log_stirling(discount)
    order = np.argsort(count, kind="stable")
    seated = np.minimum(count[order], EXACT)
    power = discount * (1.0 - prior)
    growth = np.log(np.maximum(count, EXACT) / EXACT)
    for n in np.unique(seated[seated > 1]).tolist():
        at, to = np.searchsorted(seated, [n, n + 1])
        opened = np.arange(n)
        step = max(1, _WORK // n)
        for lo in range(at, to, step):
            some = order[lo : min(lo + step, to)]
            base = strength + discount * others[some]
            # the first factor is the same for any number of tables
            weight = np.log(np.maximum(base, 1e-300)[:, None] + discount * opened)
            weight = np.cumsum(weight, axis=1)
            per_table = np.log(prior[some]) - power[some] * growth[some]
            weight += per_table[:, None] * (opened + 1) + stirling[n, 1 : n + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            picked = rng.random(len(some)) * weight[:, -1]
            tables[some] = 1 + np.minimum((weight < picked[:, None]).sum(axis=1), n - 1)
    many = order[np.searchsorted(seated, EXACT) :]
    many = many[count[many] > EXACT]
    sitting = np.full(len(many), EXACT, np.int64)
    while len(many):
        block = np.minimum(sitting // 16, count[many] - sitting)
        new = (strength + discount * (others[many] + tables[many])) * prior[many]
        new *= (sitting / count[many]) ** power[many]
        chance = new / (new + sitting - discount * tables[many])
        tables[many] += rng.binomial(block, np.clip(chance, 0.0, 1.0))
        sitting += block
        more = sitting < count[many]
        many, sitting = many[more], sitting[more]
    return tables


class _Part:
    """The restaurants' pairs of one part, seated anew after each exchange."""

    def __init__(self, state: dict, discount: float, model: Model):
        self.number, self.model, self.discount = state["part"], model, discount
        self.words = _unpack_sorted(state["words"], np.uint64)
        self.context = _unpack_sorted(state["context"])
        self.word = _unpack(state["word"])
        self.count = _unpack(state["count"])
        self.tables = (self.count > 0).astype(np.int64)
        self.total, self.samples = np.zeros(len(self.count)), 0
        self.seen = np.zeros(len(self.words), np.int64)

    def _sum(self, by: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(by, weights=values, minlength=len(self.words)).astype(np.int64)

    def sums(self) -> list[np.ndarray]:
        """Per word: customers and tables of the context, customers and tables of the dish."""
        return [
            self._sum(self.context, self.count),
            self._sum(self.context, self.tables),
            self._sum(self.word, self.count),
            self._sum(self.word, self.tables),
        ]

    def take(self, replies: list[dict], totals: list[_Totals]) -> None:
        """Go through all exchanges so far. The seed makes the same draws each time, so tables
        need not be stored."""
        model, d = self.model, self.discount
        for number, root in enumerate(totals):
            mine = sorted((r for r in replies if r["round"] == number), key=lambda r: r["root"])
            columns = [
                np.concatenate([_unpack(r["sums"][i]) for r in mine]) for i in range(5)
            ]
            customers, tables, self.seen, ordered, root_tables = columns
            own = _discount(root.ones, root.twos)
            even = (model.strength + own * root.tables) / (root.distinct + 1)
            prior = (np.maximum(ordered - own * root_tables, 0) + even) / (model.strength + root.customers)
            elsewhere = tables - self._sum(self.context, self.tables)
            if number:  # a sample: what all parts had when the sums were taken
                new = (model.strength + d * tables[self.context]) * prior[self.word]
                held = np.maximum(self.count - d * self.tables, 0)
                self.total += (held + new) / (model.strength + customers[self.context])
                self.samples += 1
            rng = np.random.default_rng([model.seed, self.number, number])
            if number + 1 < model.rounds:
                for _ in range(model.sweeps):
                    all_tables = elsewhere + self._sum(self.context, self.tables)
                    others = np.maximum(all_tables[self.context] - self.tables, 0)
                    self.tables = draw_tables(
                        self.count, others, prior[self.word], d, model.strength, rng
                    )

    def ask(self, roots: int) -> list[tuple]:
        root = ((self.words >> np.uint64(32)) * np.uint64(roots) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(root, np.arange(roots + 1)).tolist()
        sums = self.sums()
        return [
            (r, self.number, _pack_sorted(self.words[a:b]), [_pack(s[a:b]) for s in sums])
            for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            if a < b
        ]


def _ask(roots: int, discount: float, model: Model, totals: list[_Totals]):
    def first(table: pa.Table) -> pa.Table:
        return _rows(_Part(table.to_pylist()[0], discount, model).ask(roots), _UP)

    def later(state: pa.Table, replies: pa.Table) -> pa.Table:
        part = _Part(state.to_pylist()[0], discount, model)
        part.take(replies.to_pylist(), totals)
        return _rows(part.ask(roots), _UP)

    return later if totals else first


def _root(number: int, roots: int, before: _Totals | None, model: Model):
    """The root's words of one part: their sums, and their tables drawn anew."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        lists = [_unpack_sorted(r["words"], np.uint64) for r in rows]
        words, at = np.unique(np.concatenate(lists), return_inverse=True)
        sums = [
            np.bincount(
                at, np.concatenate([_unpack(r["sums"][i]) for r in rows]), len(words)
            ).astype(np.int64)
            for i in range(4)
        ]
        seen, customers = sums[2], sums[3]
        known = int((customers > 0).sum())
        if before is None:  # the other parts are like this one
            distinct, tables, discount = known * roots, known * roots, 0.5
        else:
            distinct, tables = before.distinct, before.tables
            discount = _discount(before.ones, before.twos)
        rng = np.random.default_rng([model.seed, rows[0]["root"], number, 7])
        others = np.full(len(words), max(tables - 1, 0))
        prior = np.full(len(words), 1.0 / (distinct + 1))
        drawn = draw_tables(customers, others, prior, discount, model.strength, rng)
        totals = [seen.sum(), (seen > 0).sum(), customers.sum(), drawn.sum()]
        totals += [(customers == 1).sum(), (customers == 2).sum()]
        out, end = [], 0
        for r, own in zip(rows, lists, strict=True):
            here = at[end : end + len(own)]
            end += len(own)
            columns = [sums[0], sums[1], seen, customers, drawn]
            out.append(
                (r["part"], r["root"], number, [_pack(c[here]) for c in columns], *map(int, totals))
            )
            totals = [0] * 6
        return _rows(out, _DOWN)

    return run


def _answer(discount: float, model: Model, totals: list[_Totals]):
    """For each batch, the logarithms of its pairs' averaged probabilities, and its words' counts."""

    def run(state: pa.Table, replies: pa.Table) -> pa.Table:
        row = state.to_pylist()[0]
        part = _Part(row, discount, model)
        part.take(replies.to_pylist(), totals)
        log = np.log10(part.total / part.samples).astype(np.float32)
        seen = part.seen[part.word]
        out = []
        for batch, digest, places in zip(row["batches"], row["digests"], row["places"], strict=True):
            at = _unpack_sorted(places)
            out.append((batch, part.number, digest, _pack(log[at]), _pack(seen[at]), None))
        return _rows(out, _REPLY)

    return run


def _score(tokens: int, distinct: int):
    """The texts of one batch, from what the parts say about its pairs."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        if rows[0]["part"] >= 0:
            raise RuntimeError("the texts changed between two readings")
        docs = pa.ipc.open_stream(rows[0]["third"]).read_all().to_pylist()[0]
        told = {r["part"]: r["digest"] for r in rows[1:]}
        empty = xxhash.xxh3_64_intdigest(b"")
        empty = int(np.array([empty], np.uint64).view(np.int64)[0])
        if any(told.get(i, empty) != digest for i, digest in enumerate(docs["digests"])):
            raise RuntimeError("the texts changed between two readings")
        log = np.concatenate([_unpack(r["first"], np.float64) for r in rows[1:]])
        seen = np.concatenate([_unpack(r["second"]) for r in rows[1:]])
        step, lengths = _unpack(rows[0]["first"]), _unpack(rows[0]["second"])
        starts = np.cumsum(lengths) - lengths
        pair = np.cumsum(step)
        pair -= np.repeat(pair[starts] - step[starts], lengths)
        base = np.add.reduceat(np.log10(seen[pair] + 1.0), starts)
        base -= lengths * np.log10(float(tokens + distinct + 1))
        columns = [
            docs["docs"],
            docs["held"],
            lengths,
            np.add.reduceat((seen[pair] > 0).astype(np.int64), starts),
            base,
            np.add.reduceat(log[pair], starts),
        ]
        schema = _schema(_SCORE)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    return run


# --- the whole ----------------------------------------------------------------------------


def score_texts(
    docs: DataFrame,
    held_out: Column,
    model: Model = Model(),
    key: str = "doc_id",
    text: str = "text",
    stored: bool = False,
) -> DataFrame:
    """Every text with its log10 probability under a model learned from the rows not held out.

    Tokens are the lower-cased words and one end of the text. Returns doc_id, held_out, n_tokens,
    n_known (tokens whose word the learned texts have), train_tokens, base_score (add-one
    unigrams) and score. The probabilities of a context add up to one over all learned words and
    one unknown word; they are averaged over the samples. Scores are natural for ranking and for
    perplexity: 10 ** (-sum of scores / sum of tokens).

    The texts are read twice in the same order: a table that is not `stored` is written first.
    Digests of every batch tell if they were not the same.

    Defined cases: a null or empty text has its end only; where `held_out` is null the row
    teaches; repeated rows teach and are scored each. Without rows that teach, every token has
    probability one over one unknown word. An empty table gives no rows. Only the id and the text
    are read, and what `held_out` names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pitman-yor")
    read = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    if not stored:
        read = scratch.stage(read)
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-size // PART_BYTES))
    roots = max(LEAST_PARTS, parts // 4)

    posts = read.mapInArrow(_posts(parts), _POST)
    # in buckets by part: the exchanges below move what parts say, not what they are
    gathered = posts.repartition(2 * parts, "part").groupBy("part").applyInArrow(_gather, _STATE)
    state, state_path = scratch.staged_by_key(gathered, "part", 2 * parts)
    ones, twos = _pairs_seen(state)
    discount = _discount(ones, twos)
    totals: list[_Totals] = []
    replies, paths = None, []
    for number in range(model.rounds):
        ask = _ask(roots, discount, model, totals)
        if replies is None:
            asked = state.groupBy("part").applyInArrow(ask, _UP)
        else:
            asked = state.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(ask, _UP)
        root = _root(number, roots, totals[-1] if totals else None, model)
        down, path = scratch.staged_alone(asked.groupBy("root").applyInArrow(root, _DOWN))
        paths.append(path)
        summed = down.agg(*[F.sum(c) for c in ("tokens", "distinct", "customers", "tables", "ones", "twos")])
        totals.append(_Totals(*[x or 0 for x in summed.first()]))
        replies = down if replies is None else replies.union(down)
    answers, _ = scratch.staged_alone(
        state.groupBy("part").cogroup(replies.groupBy("part"))
        .applyInArrow(_answer(discount, model, totals), _REPLY)
    )
    scratch.drop(state_path, *paths)
    last = totals[-1]
    scored = (
        read.mapInArrow(_asked(parts), _REPLY).union(answers)
        .groupBy("batch").applyInArrow(_score(last.tokens, last.distinct), _SCORE)
    )
    return scored.withColumn("train_tokens", F.lit(last.tokens).cast("long"))


def _pairs_seen(state: DataFrame) -> tuple[int, int]:
    """How many pairs were seen once, and twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                count = _unpack(blob)
                yield pa.record_batch(
                    [pa.array([int((count == n).sum())]) for n in (1, 2)], ["ones", "twos"]
                )

    seen = state.select("count").mapInArrow(run, "ones long, twos long")
    return tuple(x or 0 for x in seen.agg(F.sum("ones"), F.sum("twos")).first())
