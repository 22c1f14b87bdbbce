"""Personal data by bootstrapped contextual extraction.

Strict patterns find the seeds: values that are certainly an e-mail address,
an IP address, a card or a phone number. The words around them are candidates
for lexical patterns ("phone _", "_ ext", "card no _"). Spark scores the graph
of patterns and the values in their slots in rounds: a pattern is as good as
the share of its slots that hold known values of a kind, a value as good as the
patterns around it; values that good patterns vouch for count as known in the
next round. At last the good patterns mark, in all texts, the values of the
kind's looser form that no strict pattern could find.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import lookup
from rivulet.llm.words import by_bytes, mix, split_words, word_hashes
from rivulet.session import written

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_AT = re.compile("@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# looser forms of the kinds; that of an address is built around its sign
_SIGN = re.compile(r"@|[(\[]at[)\]]|_at_")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|[(\[]dot[)\]]|_dot_)[A-Za-z0-9-]++)*+")
_LOOSE = {
    "ip": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3}|(?:[0-9A-Fa-f]{1,4}:){2,7}:?[0-9A-Fa-f]{1,4})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{1,5}\)|[0-9])(?:[\x20()./-]{0,2}[0-9]){5,14}(?![0-9])"),
}
_EDGE = "\"'`<>()[]{},;"

#: bits of the filter of pattern hashes at least and at most (32 MB), and bits spent on a pattern
MIN_BITS, MAX_BITS, BITS_EACH = 16, 28, 16
#: one in so many texts is looked at to leave out patterns of common words, and patterns a task counts before it passes them on
SHARE, HELD = 32, 200_000


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 5,
                       precision: float = 0.8, rounds: int = 3) -> DataFrame:
    """One row per row of `docs`: (id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_added). The counts and the digest are those of the
    base spans, those the strict patterns find; `spans` holds these and the
    added ones as `kind:start:end` by start, then kind, in code points, end
    exclusive, comma-joined; the digest is the SHA-256 of the base spans written so.

    A pattern is a kind and the two words before a slot, or the two after, or one
    on each side, or the one before, A-Z in lower case and every digit as 0;
    what is attached to a value, as in `mail:x`, is a word of its own, marks
    alone are none. It is good when at least `support` distinct known values
    stand in its slots and known values of its kind make up at least
    `precision` of all its slots in all texts, whatever stands in them; values
    of the kind's looser form that are not known yet count half. A value is known if a strict pattern finds it, or once a good
    pattern holds it and it has the kind's looser form; that is repeated
    `rounds` times. Added are the values of the looser form in slots of good
    patterns that touch no base span; of two that overlap the earlier one
    stays, then the kind listed first.

    Null and empty texts have no spans; ids may be null or repeat, every row is
    a document of its own; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = written(rows.mapInArrow(_matcher, _FOUND).withColumn("row", F.monotonically_increasing_id()), "found")
    total = found.count()
    slots = found.where(F.size("slots") > 0).select("row", F.explode("slots").alias("s")).select("row", "s.*")
    slots = written(slots.select("row", "kind", "start", "end", "strict", "value", F.explode("patterns").alias("pattern")).where("pattern != 0"), "slots")
    # copies of a text count once in the graph: one edge for each pattern and value
    edges = written(slots.groupBy("kind", "pattern", "value").agg(
        F.max("strict").alias("strict"), F.count(F.lit(1)).alias("n")), "edges")
    good = _good_patterns(edges, rows, support, precision, rounds)
    picked = lookup(slots.where(~F.col("strict")), good, ["kind", "pattern"], ["good"], max(slots.count(), 1)).where("good")
    picked = picked.groupBy("row").agg(F.collect_set(F.struct("start", "end", "kind")).alias("added"), F.lit(1).alias("n_rows"))
    out = lookup(found.drop("slots"), picked, ["row"], ["added"], total)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return out.select("id", "base", "added").mapInArrow(
        _joiner(id_col), f"{id_col} long, {counts}, base_sha256 string, spans string, n_added long")


_SPAN = "struct<kind:string,start:long,end:long>"
_FOUND = (f"id long, base array<{_SPAN}>, "
          "slots array<struct<kind:string,start:long,end:long,strict:boolean,value:long,patterns:array<long>>>")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The strict matches of every kind, by start, then kind."""
    out = [("email", s, e) for s, e in _addresses(text, _AT, _DOMAIN)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and _luhn(m.group()):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in _DIGITS for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_DIGITS = frozenset("0123456789")


def _addresses(text: str, sign: re.Pattern, domain: re.Pattern) -> list[tuple[int, int]]:
    """The addresses around each sign, leftmost and longest, none reaching into the
    one before it."""
    out, at, last = [], sign.search(text), 0
    while at:
        start, m = at.start(), domain.match(text, at.end())
        while m and start > last and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at.start():
            out.append((start, m.end()))
            last = m.end()
        at = sign.search(text, max(at.end(), last))
    return out


def _luhn(text: str) -> bool:
    d = text.replace(" ", "").replace("-", "")
    if not 14 <= len(d) <= 19:
        return False
    n = [int(c) for c in reversed(d)]
    return (sum(n[::2]) + sum(2 * x - 9 * (x > 4) for x in n[1::2])) % 10 == 0


def loose_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The matches of the looser forms that touch no base span."""
    out = [("email", s, e) for s, e in _addresses(text, _SIGN, _HOST)]
    for kind in KINDS[1:]:
        for m in _LOOSE[kind].finditer(text):
            if kind == "phone" and not 7 <= sum(c in _DIGITS for c in m.group()) <= 15:
                continue
            out.append((kind, *m.span()))
    if not out or not base:
        return out
    start, end = (np.array(x) for x in zip(*sorted((s, e) for _, s, e in base)))
    high = np.maximum.accumulate(end)
    n = np.searchsorted(start, [e for _, _, e in out])  # base spans that begin before the match ends
    return [s for s, k in zip(out, n.tolist()) if not k or high[k - 1] <= s[1]]


# ---- patterns: hashes of the words around a slot ----

def _sides(before2, before1, after1, after2) -> list[np.ndarray]:
    """The four pattern hashes of slots from the hashes of the words around
    them (0: no word); a pattern without a word is 0."""
    with np.errstate(over="ignore"):
        def pair(a, b, salt):
            return np.where((a | b) == 0, np.uint64(0), mix(mix(a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) + b))

        return [pair(before2, before1, 1), pair(after1, after2, 2), pair(before1, after1, 3), pair(before1, before1, 4)]


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of every word: A-Z in lower case, digits as 0."""
    return word_hashes(pc.replace_substring_regex(words.cast(pa.large_string()), "[0-9]", "0"), lower=True)


_BEFORE = re.compile(r"[^\x20\x09-\x0D]+")


def _around(text: str, start: int, end: int) -> list[str]:
    """The two words before and the two after a slot ('' for none), as
    far as 128 code points away; what is attached to the value is a word, but
    marks alone are none."""
    left = _BEFORE.findall(text[max(0, start - 128):start])
    right = _BEFORE.findall(text[end:end + 128])
    left = [w for w in left if w.strip(_EDGE + ".")][-2:]
    right = [w for w in right if w.strip(_EDGE + ".")][:2]
    return [""] * (2 - len(left)) + left + right + [""] * (2 - len(right))


def _matcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and slots (strict or loose values with their patterns)."""
    import xxhash

    for b in (s for b in batches for s in by_bytes(b, "text")):
        base, slots, words = [], [], []
        for t in b.column("text").to_pylist():
            t = t or ""
            mine = base_spans(t)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in mine])
            here = []
            for strict, spans in ((True, mine), (False, loose_spans(t, mine))):
                for k, s, e in spans:
                    value = t[s:e].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", t[s:e])
                    here.append({"kind": k, "start": s, "end": e, "strict": strict,
                                 "value": xxhash.xxh64_intdigest(f"{k}:{value}") - (1 << 63)})
                    words += _around(t, s, e)
            slots.append(here)
        if words:
            names = pa.array(words, pa.large_string()).dictionary_encode()
            known = names.dictionary
            h = np.zeros(len(known), np.uint64)
            some = np.flatnonzero(pc.greater(pc.binary_length(known), 0).to_numpy(zero_copy_only=False))
            h[some] = _hashes(known.take(pa.array(some)))
            around = h[names.indices.to_numpy()].reshape(-1, 4).T
            sides = np.stack(_sides(*around), axis=1).view(np.int64).tolist()
            for slot, p in zip((s for d in slots for s in d), sides):
                slot["patterns"] = p
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(base, _BASE_TYPE), pa.array(slots, _SLOT_TYPE)], ["id", "base", "slots"])


_SPAN_FIELDS = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
_BASE_TYPE = pa.list_(pa.struct(_SPAN_FIELDS))
_SLOT_TYPE = pa.list_(pa.struct(_SPAN_FIELDS + [("strict", pa.bool_()), ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]))


def _good_patterns(edges: DataFrame, rows: DataFrame, support: int, precision: float, rounds: int) -> DataFrame:
    """(kind, pattern, good, n_rows) of the good patterns."""
    values = edges.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"))
    # only patterns with enough values can ever be good
    able = written(values.where(F.col("n_values") >= support).select("kind", "pattern", "n_rows"), "able")
    # a share of the texts shows which words are far too common: what it counts, all texts hold at least
    seen = _uses(able.select("pattern").distinct(), rows.where(F.pmod(F.xxhash64("text"), F.lit(SHARE)) == 0))
    able = written(able.join(seen, "pattern").where(F.col("n_rows") >= precision * F.col("n_uses")).select("kind", "pattern"), "able")
    graph = written(edges.join(able, ["kind", "pattern"], "left_semi"), "graph")
    uses = written(_uses(able.select("pattern").distinct(), rows), "uses")
    known = written(edges.where("strict").select("kind", "value").distinct(), "known")
    size = graph.groupBy("kind", "pattern").agg(F.sum("n").alias("n_rows"))
    size = size.join(uses, "pattern").select("kind", "pattern", "n_rows", F.greatest("n_uses", "n_rows").alias("n_all"))
    size = written(size, "sizes")
    for _ in range(rounds):
        hit = graph.join(known, ["kind", "value"], "left_semi").groupBy("kind", "pattern").agg(
            F.count(F.lit(1)).alias("n_known"), F.sum("n").alias("n_slots"))
        open_slots = (F.col("n_rows") - F.col("n_slots")) / 2
        good = hit.where(F.col("n_known") >= support).join(size, ["kind", "pattern"]).where(
            F.col("n_slots") >= precision * (F.col("n_all") - open_slots)).select(
            "kind", "pattern", F.lit(True).alias("good"), "n_rows")
        good = written(good, "good")
        more = graph.where(~F.col("strict")).join(good, ["kind", "pattern"], "left_semi").select("kind", "value")
        now = written(known.union(more).distinct(), "known")
        if now.count() == known.count():
            break
        known = now
    return good


def _uses(patterns: DataFrame, rows: DataFrame) -> DataFrame:
    """(pattern, n_uses): how many places of all texts have the words of the
    pattern around one word. A filter of the pattern hashes, sized by their number, keeps
    other places out of the shuffle; past its largest size it lets more through,
    which the join with the patterns removes."""
    n = patterns.count()
    bits = min(MAX_BITS, max(MIN_BITS, (n * BITS_EACH).bit_length()))
    slot = F.col("pattern").bitwiseAND(F.lit((1 << bits) - 1))
    words = patterns.groupBy(F.shiftright(slot, 5).alias("w")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pattern & 31 as int)))").alias("b")).toPandas()  # 2^bits bits at most
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    sent = rows.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(np.frombuffer(sent.value, np.uint8), bitorder="little").view(bool)
        low = np.uint64((1 << bits) - 1)
        held: Counter = Counter()
        for b in (s for b in batches for s in by_bytes(b, "text")):
            names, at, off = split_words(b.column("text"))
            if not len(at):
                continue
            bare = pc.utf8_trim(names, _EDGE + ".")
            marks = (pc.binary_length(bare).to_numpy(zero_copy_only=False) == 0)[at]
            row = np.repeat(np.arange(b.num_rows), np.diff(off))[~marks]
            h = _hashes(names)[at[~marks]]

            def near(step):  # the word so many places away in the same text, 0 for none
                out = np.zeros(len(h), np.uint64)
                if step < 0 and len(h) > -step:
                    out[-step:] = np.where(row[-step:] == row[:step], h[:step], np.uint64(0))
                elif step > 0 and len(h) > step:
                    out[:-step] = np.where(row[:-step] == row[step:], h[step:], np.uint64(0))
                return out

            every = np.concatenate(_sides(near(-2), near(-1), near(1), near(2)))
            every = every[(every != 0) & seen[(every & low).astype(np.int64)]]
            if len(every):
                p, n = np.unique(every, return_counts=True)
                held.update(dict(zip(p.view(np.int64).tolist(), n.tolist())))
            if len(held) > HELD:
                yield counted(held)
                held.clear()
        yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], ["pattern", "n"])

    places = rows.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n_uses"))
    return patterns.join(places, "pattern", "left").select("pattern", F.coalesce("n_uses", F.lit(0)).alias("n_uses"))


def _joiner(id_col: str):
    def written_spans(spans):
        return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, base, added in zip(*(c.to_pylist() for c in b.columns)):
                base = [(s["kind"], s["start"], s["end"]) for s in base]
                more, last = [], 0
                for s in sorted(added or [], key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"])):
                    if s["start"] >= last:
                        more.append((s["kind"], s["start"], s["end"]))
                        last = s["end"]
                kinds = [k for k, _, _ in base]
                out.append((i, *(kinds.count(k) for k in KINDS), hashlib.sha256(written_spans(base).encode()).hexdigest(),
                            written_spans(base + more), len(more)))
            names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(types)], names)
    return run
