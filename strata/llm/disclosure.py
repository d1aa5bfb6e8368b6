"""Sanitisation by information content, in DataFrame functions alone.

Personal data that has a form (mail and network addresses, card and phone numbers) is found by fixed patterns; its values are the *protected
entities*.  Corpus statistics then tell how much any other term gives an entity away.  With probabilities as shares of documents, a
term t beside entity c reveals PMI(c; t) = log p(c, t) / (p(c) p(t)) of the entity's information content
IC(c) = -log p(c); the share PMI / IC is 1 where every document with the term has the entity beside it.  Terms whose share
reaches a threshold are generalised, beyond a higher one removed.  Co-occurrence is counted within ``REACH`` characters of a mention, so
its rows follow the number of mentions, not of pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .term_scan import TERM_PATTERN

KINDS = ("email", "ip", "card", "phone")
GENERALISED, REMOVED = "generalise", "remove"
REACH = 80  # characters on each side of a mention
CHUNK = 1024  # characters; REACH at least
GENERALISE_AT, REMOVE_AT = 0.75, 0.9
LEAST_DOCS = 3  # documents in which a term must stand beside an entity before it can reveal it
LEAST_CHARS = 3  # shorter terms reveal nothing
SALTS = 16
RUN = 64  # matches that are summed up at once
BETWEEN_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # in texts of either case

# A match can begin at the start of a run only, or where the last match ended: runs are read once, however long they are.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)
    doubled = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(turned, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match of a pattern counts."""
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda's argument is bound, whereas an expression is repeated wherever it stands."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(values: Column) -> Column:
    """Sums of an array's values up to and with each: within runs of ``RUN`` values and over the runs before, so long arrays stay cheap."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    in_runs = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda k: F.slice(v, k * RUN + 1, F.lit(RUN)))
    before = lambda sums: F.transform(sums, lambda _, k: total(F.slice(sums, F.lit(1), k)))
    within = lambda run, base: F.transform(run, lambda _, j: base + total(F.slice(run, F.lit(1), j + 1)))
    return _bound(values, lambda v: _bound(in_runs(v), lambda runs: F.flatten(F.zip_with(runs, _bound(F.transform(runs, total), before), within))))


def _spans(kind: str, found: Column, gaps: Column) -> Column:
    """``kind, start, end, value`` of each match of a kind that counts, from the matches and the text between them."""
    steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.length(m) + F.length(g))
    spans = F.zip_with(found, running_sums(steps), lambda m, end: F.struct(F.lit(kind).alias("kind"), (end - F.length(m)).cast("bigint").alias("start"), end.cast("bigint").alias("end"), m.alias("value")))
    return F.when(F.size(found) > 0, F.filter(spans, lambda s: holds(kind, s["value"]))).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``spans``: the personal data of column ``text`` (not NULL) by fixed patterns, by kind as listed, then place, in code points."""
    t = F.col(text)
    may = {"email": F.contains(t, F.lit("@")), "ip": F.contains(t, F.lit(".")), "card": t.rlike("[0-9]"), "phone": F.contains(t, F.lit("+"))}
    rest = [F.col(c) for c in df.columns]
    # each pattern is matched once, and the text cut at its matches only where there are any
    found = df.select(*rest, *(F.when(may[k], F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"_{k}") for k in KINDS))
    cut = found.select("*", *(F.when(F.size(f"_{k}") > 0, F.split(t, PATTERNS[k], -1)).alias(f"_{k}_gaps") for k in KINDS))
    return cut.select(*rest, F.concat(*(_spans(k, F.col(f"_{k}"), F.col(f"_{k}_gaps")) for k in KINDS)).alias("spans"))


def found_rows(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Written ``row, doc_id, doc, text, spans``: every document with its base spans and a number of its own; ``doc`` holds the named columns,
    ``text`` the text of documents with finds."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.struct(F.col("doc_id").alias("_"), *(F.col(f"`{c}`") for c in columns)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    some = F.when(F.size("spans") > 0, F.col("text")).alias("text")
    return written(base_spans(rows, "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "doc", some, "spans"), "personal")


def folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def mentions(found: DataFrame) -> DataFrame:
    """``row, entity, start, end, left, right``: every base span with the text on both sides, up to ``REACH`` characters and the next span."""
    # texts are cut into chunks in one pass, so that the windows of many spans need not each walk a long text
    chunked = found.where(F.size("spans") > 0).select("row", "spans", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"))

    def window(start, n):
        k = F.floor(start / CHUNK)
        chunk = lambda i: F.coalesce(F.try_element_at("chunks", i.cast("int")), F.lit(""))
        return F.substring(F.concat(chunk(k + 1), chunk(k + 2)), (start - k * CHUNK + 1).cast("int"), n.cast("int"))

    near = chunked.select("row", F.explode(F.transform("spans", lambda s: F.struct(
        F.concat(s["kind"], F.lit(":"), folded(s["value"])).alias("entity"), s["start"].alias("start"), s["end"].alias("end"),
        window(F.greatest(s["start"] - REACH, F.lit(0)), F.least(s["start"], F.lit(REACH))).alias("left"), window(s["end"], F.lit(REACH)).alias("right")))).alias("s")).select("row", "s.*")
    by = Window.partitionBy("row").orderBy("start", "end", "entity")
    gap = near.select("*", F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.lead("start").over(by).alias("after"))
    n_left = F.greatest(F.lit(0), F.least(F.length("left"), F.col("start") - F.coalesce("before", F.lit(0))))
    n_right = F.greatest(F.lit(0), F.least(F.length("right"), F.coalesce("after", F.col("end") + REACH) - F.col("end")))
    # a term that touches the far edge of a full reach may be cut there and is left out
    left, right = F.expr("right(left, int(n_left))"), F.expr("left(right, int(n_right))")
    cut = gap.withColumns({"n_left": n_left, "n_right": n_right}).select("row", "entity", "start", "end", folded(left).alias("left"), folded(right).alias("right"), "n_left", "n_right")
    return cut.select("row", "entity", "start", "end",
                      F.when(F.col("n_left") < REACH, F.col("left")).otherwise(F.regexp_replace("left", rf"\A{TERM_PATTERN}", "")).alias("left"),
                      F.when(F.col("n_right") < REACH, F.col("right")).otherwise(F.regexp_replace("right", rf"{TERM_PATTERN}\z", "")).alias("right"))


def context_terms(found: DataFrame) -> DataFrame:
    """``row, entity, term, start, end`` of every term beside a mention that lies in no base span and has a letter."""
    sides = mentions(found).select("row", "entity", F.explode(F.array(F.struct((F.col("start") - F.length("left")).alias("at"), F.col("left").alias("text")), F.struct(F.col("end").alias("at"), F.col("right").alias("text")))).alias("s"))
    cut = sides.select("row", "entity", "s.at", F.regexp_extract_all("s.text", F.lit(TERM_PATTERN), F.lit(0)).alias("terms"), F.split("s.text", TERM_PATTERN, -1).alias("gaps")).where(F.size("terms") > 0)
    ends = running_sums(F.zip_with("terms", F.slice("gaps", F.lit(1), F.size("terms")), lambda t, g: F.length(t) + F.length(g)))
    term = cut.select("row", "entity", "at", F.explode(F.arrays_zip(F.col("terms").alias("term"), ends.alias("stop"))).alias("t")).select("row", "entity", "at", "t.*")
    return (term.select("row", "entity", "term", (F.col("at") + F.col("stop") - F.length("term")).alias("start"), (F.col("at") + F.col("stop")).alias("end"))
            .where((F.length("term") >= LEAST_CHARS) & F.col("term").rlike("[^0-9]")))


def distinct_terms(text: Column) -> Column:
    """The distinct terms of a text, folded.

    ``translate`` makes a string of every character and a pattern of terms tests each by a chain of ranges: over whole texts that is most of
    the operator's time and garbage.  So the text is cut between its terms, by a class that is a table in the engine, an ASCII text is folded by ``lower``
    (A-Z are all that it can change there) and of other texts only the distinct terms are folded, those beyond ASCII by ``translate``.
    """
    plain = lambda t: F.octet_length(t) == F.char_length(t)
    cut = lambda t: F.array_remove(F.array_distinct(F.split(t, BETWEEN_TERMS)), "")
    fold = lambda t: F.when(plain(t), F.lower(t)).otherwise(folded(t))
    return F.when(plain(text), cut(F.lower(text))).otherwise(F.array_distinct(F.transform(cut(text), fold)))


def document_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, dt``: in how many documents each of the distinct ``terms`` occurs.

    All terms of all documents are counted, per task before they are shuffled, so the work follows the text and not the number of
    terms in question.  The join is an inner one: a semi join would be pushed below the count, where it meets a row for each document of a term.
    """
    each = docs.where(F.col("text").isNotNull()).select(F.explode(distinct_terms(F.col("text"))).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("dt")).join(terms, "term")


def disclosing_terms(docs: DataFrame, found: DataFrame, context: DataFrame, generalise_at: float, remove_at: float, least_docs: int) -> DataFrame:
    """``entity, term, share, action``: the terms that give an entity away by at least ``generalise_at`` of its information content."""
    n = found.agg(F.count("*").alias("n"))
    pairs = context.select("row", "entity", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("dct")).where(F.col("dct") >= least_docs)
    pairs = written(pairs, "personal-pairs")
    named = found.select("row", F.explode(F.array_distinct(F.transform("spans", lambda s: F.concat(s["kind"], F.lit(":"), folded(s["value"]))))).alias("entity"))
    entities = named.groupBy("entity").agg(F.count("*").alias("dc"))
    known = pairs.join(entities, "entity").join(document_frequencies(docs, pairs.select("term").distinct()), "term").join(F.broadcast(n))
    ic = F.log(F.col("n") / F.col("dc"))
    pmi = F.log(F.col("n").cast("double") * F.col("dct") / (F.col("dc").cast("double") * F.col("dt")))
    share = known.where(F.col("dc") < F.col("n")).select("entity", "term", (pmi / ic).alias("share"))
    return share.where(F.col("share") >= generalise_at).withColumn("action", F.when(F.col("share") >= remove_at, REMOVED).otherwise(GENERALISED))


def _disclosed(docs: DataFrame, found: DataFrame, generalise_at: float, remove_at: float, least_docs: int) -> DataFrame:
    """``row, more``: the spans of the disclosing terms of each document that has any, in order."""
    context = written(context_terms(found), "personal-context")
    revealing = written(disclosing_terms(docs, found, context, generalise_at, remove_at, least_docs), "personal-terms")
    # a pair that a third of all documents hold is dealt to as many tasks as there are salts
    salted = revealing.select("entity", "term", "action", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hit = context.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["entity", "term", "salt"])
    one = hit.groupBy("row", "start", "end").agg(F.max("action").alias("kind"))  # of two verdicts the stricter one
    return one.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("more"))


def _located(docs: DataFrame, columns: list[str], generalise_at: float, remove_at: float, least_docs: int) -> DataFrame:
    found = found_rows(docs, columns)
    more = _disclosed(docs, found, generalise_at, remove_at, least_docs)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    bare = found.where(F.size("spans") == 0).withColumn("more", none)
    held = found.where(F.size("spans") > 0).join(more, "row", "left").withColumn("more", F.coalesce("more", none))
    return held.select(bare.columns).unionByName(bare)


def personal_spans(docs: DataFrame, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id, spans, more`` of every document: base spans (``kind, start, end, value``), and spans of the terms beside them that give their values away.

    ``more`` has kind ``generalise`` or ``remove``; places are code points, end exclusive.  NULL and empty texts have no spans; repeated rows are
    documents of their own, in counts too; an entity that every document holds has no information and is not protected from its
    context; an empty table gives no row; other columns, whatever their names, play no part.
    """
    return _located(docs, [], generalise_at, remove_at, least_docs).select("doc_id", "spans", "more")


def sanitised(docs: DataFrame, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents, all columns kept, with every span replaced: personal data by its kind, generalised terms by ``[NAME]``, ``[CODE]`` or ``[WORD]``, removed ones by nothing.

    Overlapping spans are replaced together, by the mark of the first.  Rules as in :func:`personal_spans`.
    """
    every = _located(docs, docs.columns, generalise_at, remove_at, least_docs)
    each = every.where(F.size("spans") > 0).select("row", F.explode(F.concat(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
                                                                           F.transform("more", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))).alias("s")).select("row", "s.*", "s")
    by = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = each.withColumn("new", F.when(before > F.col("start"), 0).otherwise(1)).withColumn("run", F.sum("new").over(by))
    run = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("s").getField("kind").alias("kind"))
    marks = run.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("runs"))
    cut = lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))
    behind = lambda i: F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.element_at("runs", F.greatest(i, F.lit(1)))["end"])
    pieces = F.transform("runs", lambda s, i: F.concat(cut(behind(i), s["start"]), _mark(s, cut(s["start"], s["end"]))))
    clean = F.concat(F.array_join(pieces, ""), F.expr("substring(text, int(element_at(runs, -1).end) + 1)"))
    done = every.where(F.size("spans") > 0).join(marks, "row").select("doc", clean.alias("clean"))
    same = every.where(F.size("spans") == 0).select("doc", F.col("doc")["text"].alias("clean"))
    return done.unionByName(same).select(*(F.col("clean").alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns))


def _mark(span: Column, word: Column) -> Column:
    general = F.when(word.rlike("[0-9]"), "[CODE]").when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    return F.when(span["kind"] == GENERALISED, general).when(span["kind"] == REMOVED, "").otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
