r"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are what four fixed patterns find (e-mail, IPv4, payment card, phone), each
leftmost and without overlaps of its own kind.  Other tokens that look like identifiers
are candidates.  Every mention of a seed or candidate has lexical patterns: the two words
before it, and the word before with the word after.  Patterns and distinct values form
a graph.  Each round scores every pattern by the share of its values that are known to
be of one kind; patterns with enough known values and a high share are trusted, and a
candidate that enough trusted patterns of one kind point to becomes known, which lets
the next round trust further patterns, until a round finds nothing new.  Mentions of values so discovered are added to
the document's spans; the seeds' own spans never change.

The regular expressions are spelled so that Java matches them in one pass and without
recursion, however long a run of digits or labels is: separators between two digits
(dots between two label characters) are first replaced by one character of their own, and
a match starts where its run starts or where the last match ended.  Positions are code
points; they come from the lengths of the matches and of the gaps between them.

Nulls and edge cases: a null text is empty and has no spans; a null doc_id is kept as it
is; rows that repeat an id are told apart by their text; an empty table gives an empty
result; further columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, drop_stage, stage_table

KINDS = ("email", "ip", "card", "phone")
RUN = 128  # array elements handled at a time: longer arrays cost no more an element
PIECE = 4096  # code points of a text looked at around a mention
_JOINT = "\u0001"  # stands for a separator inside a run
_LABEL, _LOCAL = "A-Za-z0-9-", "A-Za-z0-9._%+\u0001-"
EMAIL = f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[{_LABEL}]++\u0001[A-Za-z0-9\u0001-]++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = "[0-9][0-9\u0001]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_VALID = rf"^{_PART}(?:\.{_PART}){{3}}$"
# what may be an identifier: 6 to 64 letters, digits, "_" and "-", with a digit among them
CANDIDATE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]{0,63}[0-9])[A-Za-z0-9_-]{6,64}+(?![A-Za-z0-9_-])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _runs(array: Column) -> Column:
    """An array cut into arrays of ``RUN`` elements (one empty array, if it is empty)."""
    def cut(a: Column) -> Column:
        last = F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(a, i * RUN + 1, F.lit(RUN)))

    return _bound(array, cut)


def _before(amounts: Column, add) -> Column:
    """For each element of an array of integers what ``add`` makes of those before it."""
    return F.aggregate(amounts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, -1), x))))


def found(text: Column, pattern: str) -> Column:
    """All matches as an array of (start, end, value).  Ends are summed up over runs of
    matches first, then inside each run."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)),
                       lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")

    def length(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda acc, x: acc + x["g"] + F.length(x["m"]))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def spans(runs: Column) -> Column:
        begin = F.slice(_before(F.transform(runs, length), lambda a, b: a + b), F.lit(1), F.size(runs))
        return F.flatten(F.zip_with(runs, begin, lambda run, at: F.aggregate(
            run, F.struct(at.alias("at"), empty.alias("spans")), add, lambda acc: acc["spans"])))

    return _bound(_runs(pairs), spans)


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others; both are in order of their starts.  A run
    of spans is compared only with the runs of others that reach into it."""
    def ends(run: Column) -> Column:
        return F.struct(F.array_min(F.transform(run, lambda x: x["start"])).alias("low"),
                        F.array_max(F.transform(run, lambda x: x["end"])).alias("high"), run.alias("run"))

    def outside(run: Column, near: Column) -> Column:
        return F.filter(run, lambda c: ~F.exists(near, lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"])))

    def reach(e: Column, all_: Column) -> Column:
        met = F.filter(all_, lambda o: (e["low"] < o["high"]) & (o["low"] < e["high"]))
        return _bound(F.flatten(F.transform(met, lambda o: o["run"])), lambda near: outside(e["run"], near))

    return _bound(F.transform(_runs(others), ends), lambda all_: F.flatten(
        F.transform(F.transform(_runs(spans), ends), lambda e: reach(e, all_))))


def base_spans(text: Column) -> Column:
    """The seeds of a text: array of (start, kind number, end, value), in order."""
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")
    free = F.translate(text, _JOINT, "\u0002")
    dots = F.regexp_replace(free, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _JOINT)
    joins = F.regexp_replace(free, r"(?<=[0-9])[ -](?=[0-9])", _JOINT)
    email = F.when(F.contains(text, F.lit("@")), found(dots, EMAIL)).otherwise(none)
    ip = F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), found(text, IP)).otherwise(none)
    card = F.when(F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){13}")), found(joins, CARD)).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), found(text, PHONE)).otherwise(none)

    def n_digits(x: Column) -> Column:
        return F.length(_digits(x["value"]))

    ip = F.filter(ip, lambda x: F.rlike(x["value"], F.lit(IP_VALID)))
    card = F.filter(card, lambda x: F.when(n_digits(x).between(14, 19), luhn(_digits(x["value"]))).otherwise(F.lit(False)))
    phone = F.filter(phone, lambda x: n_digits(x).between(10, 15))

    def tagged(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["value"].alias("value")))

    return F.array_sort(F.concat(*[tagged(s, k) for k, s in enumerate((email, ip, card, phone))]))


def _mentions(docs: DataFrame) -> DataFrame:
    """Seeds and candidates of all documents, each with its lexical patterns."""
    digit = F.rlike("text", F.lit("[0-9]"))
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string>>)")
    candidates = F.filter(F.when(digit, found(F.col("text"), CANDIDATE)).otherwise(none),
                          lambda x: F.length(_digits(x["value"])) >= 4)
    every = F.concat(F.transform("base", lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind"), F.lower(b["value"]).alias("value"))),
        F.transform("apart", lambda c: F.struct(
            c["start"].alias("start"), c["end"].alias("end"), F.lit(None).cast("int").alias("kind"),
            F.lower(c["value"]).alias("value"))))
    # what stands around a mention comes from a piece of the text, so that a mention costs the
    # same in a text of any length: piece i begins 64 code points before i * PIECE
    last = F.floor(F.length("text") / PIECE).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(
        F.col("text"), F.greatest(i * PIECE - 63, F.lit(1)), F.least(i * PIECE, F.lit(64)) + PIECE + 32))

    def part(at: Column, back: Column | int, n: Column) -> Column:
        """``n`` code points from ``back`` before ``at`` on."""
        piece = F.floor(at / PIECE).cast("int")
        begin = F.greatest(piece * PIECE - 64, F.lit(0))
        return F.substring(F.element_at("pieces", piece + 1), at - back - begin + 1, n)

    def context(x: Column) -> Column:
        left = F.least(x["start"], F.lit(64))
        return F.struct(*[x[n].alias(n) for n in ("start", "end", "kind", "value")],
                        part(x["start"], left, left).alias("before"), part(x["end"], 0, F.lit(32)).alias("after"))

    rows = (docs.withColumn("base", base_spans(F.col("text")))
            .withColumn("apart", _apart(candidates, F.col("base"))).withColumn("pieces", pieces)
            .select("doc_id", "mark", F.explode(F.transform(every, context)).alias("mention"))
            .select("doc_id", "mark", "mention.*"))
    before, after = F.col("before"), F.col("after")

    def word(part: Column, pattern: str) -> Column:
        return F.regexp_replace(F.lower(F.regexp_extract(part, pattern, 1)), "[0-9]", "0")

    one, two = r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$"
    left, left2 = word(before, one), F.regexp_replace(word(before, two), r"[\x20\x09-\x0D]+", " ")
    right = word(after, r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)")
    patterns = F.array_distinct(F.filter(F.array(
        F.when(left2 != "", F.concat(F.lit("L:"), left2)),
        F.when((left != "") & (right != ""), F.concat(F.lit("M:"), left, F.lit(" _ "), right))),
        lambda p: p.isNotNull()))
    return rows.select("doc_id", "mark", "start", "end", "kind", "value", patterns.alias("patterns"))


def discover(mentions: DataFrame, least_known: int = 3, least_share: float = 0.8,
             least_patterns: int = 2) -> DataFrame:
    """(value, kind) of the candidates that trusted patterns point to.  The known values
    only grow, so the rounds end."""
    graph = stage_table(mentions.select(F.explode("patterns").alias("pattern"), "value", "kind")
                        .groupBy("pattern", "value").agg(F.min("kind").alias("kind")), "graph")
    totals = stage_table(graph.groupBy("pattern").agg(F.count("*").alias("n"))
                         .filter(F.col("n") > least_known).withColumnRenamed("pattern", "p"), "totals")
    edges = stage_table(graph.join(totals, F.col("pattern") == F.col("p")).drop("p"), "pairs")
    seeds = stage_table(edges.filter("kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("known"))
                        .withColumnRenamed("value", "v"), "known")
    known, added = seeds, None
    while True:
        told = edges.join(known, F.col("value") == F.col("v"), "left")
        trusted = (told.filter("known IS NOT NULL").groupBy("pattern", "known", "n").agg(F.count("*").alias("hits"))
                   .filter((F.col("hits") >= least_known) & (F.col("hits") >= F.lit(least_share) * F.col("n")))
                   .select(F.col("pattern").alias("p"), F.col("known").alias("as_kind"), "hits"))
        fresh = (told.filter("known IS NULL").join(trusted, F.col("pattern") == F.col("p"))
                 .groupBy("value", "as_kind").agg(F.count("*").alias("k"), F.sum("hits").alias("weight"))
                 .filter(F.col("k") >= least_patterns)
                 .groupBy("value").agg(F.max(F.struct("k", "weight", (-F.col("as_kind")).alias("kind"))).alias("best"))
                 .select(F.col("value").alias("v"), (-F.col("best.kind")).alias("known")))
        fresh = stage_table(fresh, "fresh")
        if fresh.isEmpty():
            break
        if added is None:
            added = fresh
        else:  # one table, however many rounds there are
            both = stage_table(added.unionByName(fresh), "added")
            drop_stage(added, fresh)
            added = both
        known = seeds.unionByName(added)
    drop_stage(graph, totals)
    if added is None:
        added = seeds.limit(0)
    return added.select(F.col("v").alias("value"), F.col("known").alias("kind"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _spans(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds of each document, and the spans that the method adds, by document."""
    docs = columns_of(documents, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    mentions = stage_table(_mentions(docs), "mentions")
    found_ = discover(mentions)
    more = (mentions.filter("kind IS NULL").drop("kind").join(found_, "value")
            .groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m"))
            .agg(F.collect_set(F.struct("start", "kind", "end")).alias("more")))
    base = mentions.filter("kind IS NOT NULL").groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("base"))
    return base, more


def _with_spans(docs: DataFrame, base: DataFrame, more: DataFrame) -> DataFrame:
    """``docs`` (doc_id, mark, ...) with the arrays ``base`` and ``spans``; what is added never
    overlaps a seed, so the two have no span in common."""
    empty = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")
    b = base.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), "base")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))
    joined = docs.join(b, same, "left").drop("_d", "_m")
    joined = joined.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left").drop("d", "m")
    return (joined.withColumn("base", F.coalesce("base", empty))
            .withColumn("spans", F.array_sort(F.concat(F.col("base"), F.coalesce("more", empty)))).drop("more"))


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each document."""
    base, more = _spans(documents)
    docs = columns_of(documents, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    out = _with_spans(docs, base, more)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                      _joined(F.col("spans")).alias("spans"))


def redact(documents: DataFrame) -> DataFrame:
    """All columns of ``documents``; in the text, spans are replaced by their kind in
    brackets (overlapping spans by the first one's)."""
    base, more = _spans(documents)
    # the input row travels as one struct, so none of its names can clash
    marked = documents.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    rows = _with_spans(marked, base, more)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def masked(part: Column, begin: Column, run: Column) -> Column:
        """The text from ``begin`` to the last end of a run of spans; ``part`` starts at ``begin``."""
        def add(acc: Column, s: Column) -> Column:
            piece = F.concat(acc["out"], F.substring(part, acc["at"] - begin + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                             F.element_at(names, s["kind"] + 1))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out"))

        return F.aggregate(run, F.struct(begin.alias("at"), F.lit("").alias("out")), add, lambda acc: acc["out"])

    def rebuilt(runs: Column) -> Column:
        highs = F.transform(runs, lambda run: F.array_max(F.transform(run, lambda s: s["end"])))
        return _bound(_before(highs, F.greatest), lambda begin: F.concat(
            F.array_join(F.zip_with(runs, F.arrays_zip(
                F.slice(begin, F.lit(1), F.size(runs)).alias("a"), F.slice(begin, F.lit(2), F.size(runs)).alias("b")),
                lambda run, at: _bound(F.substring(F.col("text"), at["a"] + 1, at["b"] - at["a"]),
                                       lambda part: masked(part, at["a"], run))), ""),
            F.substring(F.col("text"), F.element_at(begin, -1) + 1, F.length("text"))))

    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(_bound(_runs(F.col("spans")), rebuilt))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
