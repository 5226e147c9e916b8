"""Large ordered dictionaries over text: all signals by one automaton, aliases by a flattened trie."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.files import stored

#: Bytes of signals that one automaton holds; a dictionary with more is split and applied part by part.
PART_BYTES = 32 << 20


def automaton(signals: list[tuple]):
    """An Aho-Corasick automaton of (ord, signal, label), and the one entry that fits every text, if any: (automaton,
    entries in order, number of the empty signal or None)."""
    import ahocorasick

    entries = sorted(signals, key=lambda s: (s[0] is not None, s[0], s[1]))
    found, always = ahocorasick.Automaton(), None
    for rank, (_, signal, _) in enumerate(entries):
        if signal == "":
            always = rank if always is None else always
        elif signal not in found:
            found.add_word(signal, (rank, len(signal)))
    found.make_automaton()
    return found, entries, always


def _scan(held, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column is the best entry so far; it becomes the best of it and of what the automaton finds in the first one."""
    found, entries, always = held.value
    for batch in batches:
        best = []
        for text, before in zip(batch.column(0), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            text = text.as_py()
            rank, at = (None, None) if always is None or text is None else (always, 1)
            if text and len(found):
                for end, (k, size) in found.iter(text):
                    if rank is None or k < rank:
                        rank, at = k, end - size + 2
            here = None if rank is None else dict(zip(("ord", "signal", "label"), entries[rank], strict=True)) | {"at": at}
            order = lambda x: (x["ord"] is not None, x["ord"], x["signal"])
            best.append(min((x for x in (before, here) if x is not None), key=order, default=None))
        kind = batch.schema.field(batch.num_columns - 1).type
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, kind)], names=batch.schema.names)


def match_signals(rows: DataFrame, text: str, dictionary: DataFrame, *, part_bytes: int = PART_BYTES) -> DataFrame:
    """``rows`` with ``match``: the entry of ``dictionary`` (ord, signal, label) with the lowest ord (ties: the smallest
    signal, then the smallest label) whose signal occurs in the text, and ``at``, where it first occurs (characters, from 1).

    One automaton holds all signals, so a text is read once, however many there are. The dictionary's size is measured
    first; one of more than ``part_bytes`` is split by hash, and its parts are applied one after another, each broadcast
    alone. Null signals are none; an empty signal occurs in every text; a null text has no match. Rows are kept one by one.
    """
    session = rows.sparkSession
    known = dictionary.where("signal is not null").groupBy("ord", "signal").agg(F.min("label").alias("label"))
    known = stored(known, "signals")
    size = known.agg(F.sum(F.octet_length("signal") + F.coalesce(F.octet_length(F.col("label").cast("string")), F.lit(0)))).first()[0] or 0
    parts = int(size // part_bytes) + 1
    kind = "struct<" + ",".join(f"{c}:{t}" for c, t in [(c, dict(known.dtypes)[c]) for c in ("ord", "signal", "label")]) + ",at:int>"
    others = [c for c in rows.columns if c not in (text, "match")]
    out = rows.select(text, *others, F.lit(None).cast(kind).alias("match"))
    schema = out.schema
    for k in range(parts):
        some = known.where(F.pmod(F.xxhash64("signal"), F.lit(parts)) == k).select("ord", "signal", "label").collect()  # about part_bytes
        held = session.sparkContext.broadcast(automaton([tuple(r) for r in some]))
        out = out.mapInArrow(lambda batches, held=held: _scan(held, batches), schema)
        if k < parts - 1:
            out = stored(out, "matched")
    return out.select(*[c for c in rows.columns if c != "match"], "match")


def first_prefix(texts: DataFrame, text: str, *tables: DataFrame) -> DataFrame:
    """``texts`` with ``match`` (table, ord, prefix, label): of the aliases (ord, prefix, label) that begin the text, that of the
    first table that has any, there the lowest ord (ties: the shortest prefix, then the smallest label).

    The aliases are a flattened trie: a text gives only its beginnings of the lengths that aliases have, and these meet the
    aliases in an equi-join. Each different text is looked up once. Null prefixes and texts have no match; the empty prefix
    begins every text.
    """
    entry = lambda k, t: t.where("prefix is not null").select(F.lit(k).alias("table"), "ord", "prefix", F.col("label").cast("string").alias("label"))
    aliases = reduce(DataFrame.unionByName, [entry(k, t) for k, t in enumerate(tables)])
    lengths = [r[0] for r in aliases.select(F.length("prefix")).distinct().collect()]  # as many as the longest alias has characters at most
    own = texts.select(F.col(text).alias("_text")).where("_text is not null").distinct()
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("_text")), lambda n: F.substring(F.col("_text"), F.lit(1), n))
    met = own.select("_text", F.explode(starts).alias("prefix")).join(aliases, "prefix")
    order = F.struct("table", "ord", F.length("prefix").alias("n"), "label", "prefix")
    best = met.groupBy("_text").agg(F.min(order).alias("m")).select("_text", F.struct("m.table", "m.ord", "m.prefix", "m.label").alias("match"))
    kept = texts.drop("match")
    return kept.join(best, kept[text] == best["_text"], "left").drop("_text")


#: Fixed value: what a vendor's index name ends with when it names its return variant and currency.
VARIANT = r"\s+(nr|gr|tr)\s+(usd|eur|gbp|jpy|chf|cnh|cny|sek|aud|twd)\s*$"


def normal_names(names: DataFrame, name: str, first: DataFrame, second: DataFrame, *, variant: str = VARIANT) -> DataFrame:
    """``names`` with the ``match`` of their canonical name: an alias of ``first`` that begins the cleaned name, else one of
    ``second``, else one of ``second`` without its variant that begins the name without its own. Both tables are (ord, prefix, label)."""
    clean = F.trim(F.regexp_replace(F.lower(F.col(name)), r"\s+", " "))
    short = F.trim(F.regexp_replace(F.col("_clean"), variant, ""))
    bare = second.withColumn("prefix", F.trim(F.regexp_replace("prefix", variant, "")))
    rows = names.drop("match").withColumn("_clean", clean).withColumn("_short", short)
    rows = first_prefix(rows, "_clean", first, second).withColumnRenamed("match", "_whole")
    rows = first_prefix(rows, "_short", bare)
    other = F.when(F.col("_short") != F.col("_clean"), F.col("match").withField("table", F.lit(2)))
    return rows.withColumn("match", F.coalesce("_whole", other)).drop("_clean", "_short", "_whole")
