"""Language identification by prediction by partial matching over bytes.

Per language a context tree of depth `DEPTH` counts which byte follows which up to three bytes. The
counts come from all training texts by one aggregation in Spark, and every counted node counts. While there
are at most 1 / `FLOOR` of them per language, and tables by language fit `HELD_BYTES`, they are collected; else the most frequent grams
are, with their code lengths, as many as that allows however many languages there are, and the other grams of a text are looked up
in the stored counts of all depths by joins; of those only single bytes are tables by language.
Code lengths are added up in whole units of 1 / `UNIT` bits, so both ways give the same. With the counts
frozen, a byte costs -log2 of its share under the longest context that knows it, plus the escapes on the way
there (an escape has the share of one count per distinct follower); the last resort is one of 256 bytes. The
three zeros before a text are a context only where they occur within texts. The language with the shortest
code for the whole text wins; the score is its posterior share against the others.

Edge cases: a text that is null or has no letter is `und` with score 0, as is every text if nothing could
be learned; documents without language, text or id are not learned from; equal code lengths go to the
first name; repeated rows get a row each; an empty table gives an empty table; columns other than
doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm import common as C
from folioflow.session import stored, stored_count

DEPTH = 4
FLOOR = 2.0**-15
UNIT = 1 << 28
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
# Distinct grams of a language that a counting task holds before it hands them on.
HELD = 1 << 20
# What driver and tasks hold of a model: a figure per gram and language.
HELD_BYTES = 64 << 20


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def contexts(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The byte itself and the 1 to DEPTH - 1 bytes before it, zero before a text's start."""
    starts = starts[starts < len(data)]
    out = [data]
    for _ in range(DEPTH - 1):
        before = np.empty_like(data)
        before[1:] = out[-1][:-1]
        before[starts] = 0
        out.append(before)
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(lang: str) -> pa.RecordBatch:
        keys, counts = held.pop(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
        )

    for batch in C.slices(batches):
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        for lang in sorted(set(langs)):
            data, offsets = C.text_bytes(batch.column("text").filter(pa.array(langs == lang)))
            if not len(data):
                continue
            key = np.zeros(len(data), np.uint32)
            for i, byte in enumerate(contexts(data, offsets[:-1])):
                key |= byte.astype(np.uint32) << np.uint32(8 * i)
            new = np.unique(key, return_counts=True)
            held[lang] = _merged([held[lang], new]) if lang in held else new
            if len(held[lang][0]) > HELD:
                yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def _count(keys: np.ndarray, at: np.ndarray, lang: np.ndarray, n: np.ndarray, number: int) -> np.ndarray:
    """Sums of n by language (rows) and key (columns)."""
    out = np.zeros((number, len(keys)), np.int64)
    np.add.at(out, (lang, at), n)
    return out


def _cost(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of a byte seen n times after its context; where never, an escape and its bits after a shorter one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        return np.where(n > 0, -np.log2(n / (total + kinds)), escape + shorter)


def _taken(keys: np.ndarray, values: list[np.ndarray], wanted: np.ndarray) -> list[np.ndarray]:
    """Columns of the values by sorted key, zero for a key that is not there."""
    if not len(keys):
        return [np.zeros((len(v), len(wanted)), np.int64) for v in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return [v[:, at] * (keys[at] == wanted) for v in values]


class Model:
    """Frozen counts of all languages.

    A `complete` model holds them all, contexts of up to two bytes as dense tables. Any other holds the code
    lengths of the most frequent grams, and single bytes; all counts are the stored `tables`.
    """

    def __init__(self, langs: list[str], single: np.ndarray, total: np.ndarray, kinds: np.ndarray):
        """single: counts of bytes by language (rows); total, kinds: occurrences and kinds of what follows a byte."""
        self.langs, self.tables = langs, None
        self.cost1 = _cost(single, single.sum(1, keepdims=True), (single > 0).sum(1, keepdims=True), np.full((len(langs), 1), 8.0))
        self.total1, self.kinds1 = total, kinds

    @classmethod
    def whole(cls, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
        """From all counts of four bytes."""
        number, dense = len(langs), np.arange(1 << 16)
        triples, three = np.unique(gram & 0xFFFFFF, return_inverse=True)
        counts3 = _count(triples, three, lang, n, number)
        pair = _count(dense, gram & 0xFFFF, lang, n, number)
        rows = pair.reshape(number, 256, 256)
        out = cls(langs, rows.sum(1), rows.sum(2), (rows > 0).sum(2))
        out.cost2 = out._cost2(dense, pair)
        of, at = np.nonzero(counts3)
        out.total2, out.kinds2 = [_count(dense, triples[at] >> 8, of, x, number) for x in (counts3[of, at], np.ones(len(of), np.int64))]
        fours, four = np.unique(gram, return_inverse=True)
        contexts3, three = np.unique(gram >> 8, return_inverse=True)
        after = [_count(contexts3, three, lang, x, number) for x in (n, np.ones(len(n), np.int64))]
        out.complete, out.zeros = True, _taken(triples, [counts3], np.zeros(1, np.int64))[0]
        out.held = (fours, [_count(fours, four, lang, n, number)]), (contexts3, after), (triples, [counts3])
        return out

    @classmethod
    def partial(cls, langs: list[str], grams: DataFrame, room: int) -> Model:
        """From stored counts (lang, gram, n); code lengths of the `room` most frequent grams are held."""
        number = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int").alias("i")
        grams = grams.select(number, "gram", "n")
        low = lambda size: F.col("gram").bitwiseAND(F.lit(size).cast("long")).alias("gram")
        high = F.shiftright("gram", 8).alias("gram")
        after = [F.sum("n").alias("n"), F.count("*").alias("kinds")]
        threes = stored(grams.groupBy("i", low(0xFFFFFF)).agg(F.sum("n").alias("n")))
        twos = stored(threes.groupBy("i", low(0xFFFF)).agg(F.sum("n").alias("n")))

        def bytes_of(rows: DataFrame, *names: str) -> list[np.ndarray]:
            """Tables of 256 bytes by language."""
            table = rows.toArrow()
            at = [table.column(c).to_numpy() for c in ("i", "gram", *names)]
            return [_count(np.arange(256), at[1], at[0], n, len(langs)) for n in at[2:]]

        single = bytes_of(twos.groupBy("i", low(0xFF)).agg(F.sum("n").alias("n")), "n")[0]
        out = cls(langs, single, *bytes_of(twos.groupBy("i", high).agg(*after), "n", "kinds"))
        parts = lambda df, *names: stored(df.groupBy("gram").agg(F.collect_list(F.struct("i", *names)).alias("parts")))
        out.tables = {
            "p4": parts(grams, "n"),
            "c3": parts(grams.groupBy("i", high).agg(*after), "n", "kinds"),
            "p3": parts(threes, "n"),
            "c2": parts(threes.groupBy("i", high).agg(*after), "n", "kinds"),
            "p2": parts(twos, "n"),
        }
        out.complete, out.zeros = False, np.zeros((len(langs), 1), np.int64)
        for row in threes.where("gram = 0").collect():
            out.zeros[row.i] = row.n
        first = grams.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(room)
        keys, units = out.stored_units(first.select("gram")).toArrow().columns
        keys, units = keys.to_numpy(), units.combine_chunks().flatten().to_numpy().reshape(-1, len(langs)).T
        order = np.argsort(keys)
        out.held = keys[order], np.ascontiguousarray(units[:, order])
        return out

    def _cost2(self, pair: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Bits of the last of two bytes, seen n times."""
        before, byte = pair >> 8 & 255, pair & 255
        return _cost(n, self.total1[:, before], self.kinds1[:, before], self.cost1[:, byte])

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}

    def _units(self, gram: np.ndarray, n4: np.ndarray, total3: np.ndarray, kinds3: np.ndarray, n3: np.ndarray, pairs: tuple | None = None) -> np.ndarray:
        """Code lengths of the last byte of grams, in units of 1 / UNIT bits. pairs: occurrences and kinds of what follows the two
        bytes before it, and how often the last two are, where they are no tables."""
        context = (gram >> 8) & 0xFFFF
        inner = (gram >> 8 != 0) | (self.zeros > 0)
        if pairs is None:
            total2, kinds2, cost2 = self.total2[:, context], self.kinds2[:, context], self.cost2[:, gram & 0xFFFF]
        else:
            total2, kinds2, cost2 = pairs[0], pairs[1], self._cost2(gram & 0xFFFF, pairs[2])
        cost3 = _cost(n3, total2, kinds2, cost2)
        return np.rint(_cost(n4 * inner, total3 * inner, kinds3, cost3) * UNIT).astype(np.int64)

    def stored_units(self, wanted: DataFrame) -> DataFrame:
        """(gram, units): code lengths by language of the column `gram`, from the stored tables."""
        shared, number = wanted.sparkSession.sparkContext.broadcast(self), len(self.langs)

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:

                def counts(column: str, *names: str) -> list[np.ndarray]:
                    lists = batch.column(column)
                    at, inner = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
                    out = [np.zeros((number, len(lists)), np.int64) for _ in names]
                    for values, name in zip(out, names):
                        values[inner.field("i").to_numpy(), at] = inner.field(name).to_numpy()
                    return out

                gram = batch.column("gram").to_numpy()
                pairs = *counts("c2", "n", "kinds"), *counts("p2", "n")
                units = shared.value._units(gram, *counts("p4", "n"), *counts("c3", "n", "kinds"), *counts("p3", "n"), pairs)
                units = pa.ListArray.from_arrays(np.arange(len(gram) + 1, dtype=np.int32) * number, np.ascontiguousarray(units.T).ravel())
                yield pa.RecordBatch.from_arrays([batch.column("gram"), units], ["gram", "units"])

        low = lambda size: F.lit(size).cast("long")
        before = F.shiftright("gram", 8)
        keys = {"p4": F.col("gram"), "c3": before, "p3": F.col("gram").bitwiseAND(low(0xFFFFFF)), "c2": before.bitwiseAND(low(0xFFFF)), "p2": F.col("gram").bitwiseAND(low(0xFFFF))}
        rows = wanted.select("gram", *[key.alias(f"k_{name}") for name, key in keys.items()])
        for name, table in self.tables.items():
            rows = rows.join(table.select(F.col("gram").alias(f"k_{name}"), F.col("parts").alias(name)), f"k_{name}", "left")
        return C.map_arrow(rows.select("gram", *keys), step, "gram long, units array<long>")

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Units per language (rows) and text (columns), and (text, gram, times) of the grams not held."""
        out = np.zeros((len(self.langs), len(offsets) - 1), np.int64)
        none = np.zeros(0, np.int64)
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return out, (none, none, none)
        key = np.zeros(len(data), np.uint32)
        for i, byte in enumerate(contexts(data, offsets[:-1])):
            key |= byte.astype(np.uint32) << np.uint32(8 * i)
        gram, at = np.unique(key, return_inverse=True)
        gram = gram.astype(np.int64)
        if self.complete:
            four, after, three = self.held
            units = self._units(gram, *_taken(*four, gram), *_taken(*after, gram >> 8), *_taken(*three, gram & 0xFFFFFF))
            missed = none
        else:
            units = _taken(self.held[0], [self.held[1]], gram)[0]
            missed = np.flatnonzero(~np.isin(gram, self.held[0])[at])
        for i in range(len(self.langs)):
            out[i, full] = np.add.reduceat(units[i][at], offsets[full])
        text = np.searchsorted(offsets, missed, side="right") - 1
        pairs, times = np.unique(text * len(gram) + at[missed], return_counts=True)
        return out, (pairs // len(gram), gram[pairs % len(gram)], times)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits per language (rows) and text (columns), of a complete model."""
        return self.units(data, offsets)[0] / UNIT

    def verdict(self, units: np.ndarray, sizes: np.ndarray) -> list:
        """lang_pred, score and bits_per_byte from units per language (rows) and text (columns)."""
        bits = units / UNIT
        best, least = bits.argmin(0), bits.min(0)
        score = 1 / np.exp2(least - bits).sum(0)
        return [pa.array([self.langs[i] for i in best], pa.string()), pa.array(score), pa.array(least / np.maximum(sizes, 1))]


def learn(docs: DataFrame) -> Model:
    """Trees from the texts with a language outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != HELD_OUT))
    grams = C.map_arrow(rows.select("lang", "text"), _grams, "lang string, gram long, n long")
    grams, size = stored_count(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    langs = sorted(r.lang for r in grams.select("lang").distinct().collect())
    room = min(int(len(langs) / FLOOR), HELD_BYTES // (8 * max(1, len(langs))))
    if size > room or len(langs) << 19 > HELD_BYTES:
        return Model.partial(langs, grams, room)
    number = {lang: i for i, lang in enumerate(langs)}
    rows = grams.toArrow()
    lang = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    return Model.whole(langs, lang, rows.column("gram").to_numpy(), rows.column("n").to_numpy())


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """`carry`, then lang_pred, score and bits_per_byte. Only the text is read for the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = "lang_pred string, score double, bits_per_byte double"

    def compute(text: pa.Array) -> list:
        own = shared.value
        if not own.langs:
            return [[UNKNOWN] * len(text), [0.0] * len(text), [0.0] * len(text)]
        data, offsets = C.text_bytes(text)
        return own.verdict(own.units(data, offsets)[0], np.diff(offsets))

    if model.complete:
        return C.per_row(docs, carry, compute, fields, "text")

    def known(text: pa.Array) -> list:
        data, offsets = C.text_bytes(text)
        units, (row, gram, times) = shared.value.units(data, offsets)
        bounds = pa.array(np.searchsorted(row, np.arange(len(text) + 1)), pa.int32())
        every = pa.array(np.arange(len(text) + 1) * len(units), pa.int32())
        lists = [(every, np.ascontiguousarray(units.T).ravel()), (bounds, gram), (bounds, times)]
        return [np.diff(offsets), *[pa.ListArray.from_arrays(b, pa.array(v, pa.int64())) for b, v in lists]]

    plain = [f"c{i}" for i in range(len(carry))]
    rows = C.per_row(docs, carry, known, "size long, units array<long>, grams array<long>, times array<long>", "text")
    rows = stored(rows.toDF(*plain, "size", "units", "grams", "times").withColumn("place", F.monotonically_increasing_id()))
    missed = rows.select("place", F.explode(F.arrays_zip("grams", "times")).alias("one")).select("place", F.col("one.grams").alias("gram"), "one.times")
    units = stored(model.stored_units(missed.select("gram").distinct()))
    sums = [F.sum(F.col("times") * F.col("units")[i]) for i in range(len(model.langs))]
    more = missed.join(units, "gram").groupBy("place").agg(F.array(*sums).alias("more"))
    every = F.coalesce(F.zip_with("units", "more", lambda a, b: a + b), "units").alias("units")
    rows = rows.drop("grams", "times").join(more, "place", "left").select(*plain, "size", every)
    schema = T.StructType([rows.schema[n] for n in plain] + T.StructType.fromDDL(fields).fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("units").flatten().to_numpy().reshape(batch.num_rows, -1).T
            found = shared.value.verdict(units, batch.column("size").to_numpy())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in plain], *found], schema.names)

    return C.map_arrow(rows, judge, schema).toDF(*carry, *schema.names[len(plain) :])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte, one row per input row."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"),
        lettered.alias("lettered"),
        "text",
    )
    out = predict(rows, model, ["doc_id", "held_out", "lettered"])
    known = F.col("lettered")
    return out.select(
        "doc_id",
        "held_out",
        F.when(known, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        "bits_per_byte",
    )
