"""Personal data by bootstrapped contextual extraction.

Native: DataFrame expressions only. Base entities are found by pattern in one pass over each text.
They seed the bootstrap: the one to three words on either side of an entity are lexical patterns.
Patterns and instances form a graph; a pattern is as good as the share of its instances (entities of any
kind and runs of the right shape) that are known or believed, an instance as good as the best pattern
that holds, and the scores are computed in turns. A pattern never supports itself. Patterns that
hold and have enough distinct seeds find identifiers of other shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, rewritten so that they never backtrack over a long run: a match of the plain
#: form can only start where a run of its first class starts, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no entity of the kind.
_GATES = {
    "email": r"@[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9][\x20().0-9-]{8}",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_SPACE = r"\x20\x09-\x0D"
#: Runs that an unseen identifier of a kind can be: they start at white space or right after a cue such as "phone=", and
#: may hold spaces. The second form has none; it counts where the first runs into another entity.
SHAPES = {
    "email": (rf"(?<![^{_SPACE}:=#<>()\[\]\"',;])[^{_SPACE}@:=#<>()\[\]\"',;]++@[^{_SPACE}@<>()\[\]\"',;]*+[^{_SPACE}@<>()\[\]\"',;.:!?](?<![.:!?])",),
    "ip": (r"(?<![0-9A-Za-z.])(?<![0-9A-Fa-f:]:)(?=[0-9A-Fa-f.]*+:)[0-9A-Fa-f:.]*[0-9A-Fa-f](?![0-9A-Za-z])",),
    "card": (r"(?<![0-9A-Za-z*])[0-9Xx*](?:[\x20-]?[0-9Xx*]){7,30}(?![0-9A-Za-z*])", r"(?<![0-9A-Za-z*])[0-9Xx*](?:-*+[0-9Xx*]){7,30}(?![0-9A-Za-z*])"),
    "phone": (r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])", r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[().+/-]*+[0-9]){6,14}(?![0-9A-Za-z])"),
}
#: Characters of context on each side, words of a pattern, rounds of scoring, and what a pattern needs.
CONTEXT, WORDS, ROUNDS, MIN_SEEDS, MIN_SCORE = 48, 3, 3, 5, 0.8
_SPANS = "array<struct<start:int,end:int>>"
_OCCURRENCES = "array<struct<kind:int,start:int,end:int,value:string,contexts:array<string>>>"
_ENTITIES = "array<struct<kind:int,start:int,end:int,value:string,cue:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum is a multiple of ten; every second digit from the right counts double, less 9 if over 9."""
    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(x)).between(14, 19), _luhn(_digits(x))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(x)).between(10, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, keep) -> Column:
    """Start and end (code points) of the matches that keep accepts: matches and the text between them alternate."""
    steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(_SPANS)
        found = F.when(x["hit"].isNotNull() & keep(x["hit"]), F.concat(acc["found"], one)).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found")), step, lambda acc: acc["found"])


def _contexts(text: Column, start: Column, end: Column) -> Column:
    """Both sides of a span: "< words" before and "> words" after it, one to WORDS words each.

    Lower-cased, digits as 0, white space as one space; marks next to the span don't count. A word that CONTEXT cuts is left out.
    """
    begin = F.greatest(start - CONTEXT, F.lit(0))
    before = F.concat(F.when(begin == 0, " ").otherwise(""), F.substring(text, begin + 1, start - begin))
    after = F.concat(F.substring(text, end + 1, F.lit(CONTEXT)), F.when(F.length(text) <= end + CONTEXT, " ").otherwise(""))

    def plain(x: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.lower(x), "[0-9]+", "0"), rf"[{_SPACE}]+", " ")

    sides = F.array(F.struct(
        F.regexp_replace(plain(before), r"[\x20\"'(\[<]+$", "").alias("left"), F.regexp_replace(plain(after), r"^[\x20\"')\]>.,;:!?]+", "").alias("right")))

    def cut(side: Column) -> Column:
        word = r"[^\x20]+"
        left = [F.regexp_extract(side["left"], rf"\x20({word}(?:\x20{word}){{{n}}})$", 1) for n in range(WORDS)]
        right = [F.regexp_extract(side["right"], rf"^({word}(?:\x20{word}){{{n}}})\x20", 1) for n in range(WORDS)]
        found = [F.when(x != "", F.concat(F.lit(mark), x)) for mark, xs in (("< ", left), ("> ", right)) for x in xs]
        return F.array_compact(F.array(*found))

    return F.transform(sides, cut)[0]


def _occurrence(text: Column, kind: Column, start: Column, end: Column) -> Column:
    return F.struct(kind.alias("kind"), start.alias("start"), end.alias("end"), F.substring(text, start + 1, end - start).alias("value"),
                    _contexts(text, start, end).alias("contexts"))


def _apart(spans: Column, taken: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def occurrences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_hash, base (all entities of the base patterns) and other (runs that may be more, by kind).

    One pass over each whole text; null counts as empty.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole, none = F.col("text"), F.array().cast(_SPANS)

    def described(number: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: _occurrence(whole, F.lit(number), s["start"], s["end"])).cast(_OCCURRENCES)

    def gated(number: int, kind: str, pattern: str) -> Column:
        return F.coalesce(F.when(whole.rlike(pattern), _spans(whole, pattern, lambda x: _fits(F.lit(number), x))), none)

    for i, k in enumerate(KINDS):
        plain = plain.withColumn(f"b{i}", F.coalesce(F.when(whole.rlike(_GATES[k]), _spans(whole, PATTERNS[k], lambda x, k=k: _valid(k, x))), none))
    plain = plain.withColumn("taken", F.concat(*[F.col(f"b{i}") for i in range(len(KINDS))]))
    for i, k in enumerate(KINDS):
        plain = plain.withColumn(f"c{i}", _apart(gated(i, k, SHAPES[k][0]), F.col("taken")))
        for pattern in SHAPES[k][1:]:
            plain = plain.withColumn(f"c{i}", F.concat(f"c{i}", _apart(gated(i, k, pattern), F.concat("taken", f"c{i}"))))
    return plain.select(
        "doc_id", "text_hash", F.concat(*[described(i, F.col(f"b{i}")) for i in range(len(KINDS))]).alias("base"),
        F.concat(*[described(i, F.col(f"c{i}")) for i in range(len(KINDS))]).alias("other"))


def _fits(kind: Column, value: Column) -> Column:
    """Shapes that an unseen identifier of a kind can have."""
    digits = F.length(_digits(value))
    return (
        F.when(kind == 0, value.rlike("^[^@]+@[^@]+$"))
        .when(kind == 1, value.rlike(r"^[0-9A-Fa-f:.]+$") & value.contains(":") & value.rlike("[0-9]"))
        .when(kind == 2, value.rlike("^[0-9Xx* -]+$") & digits.between(8, 19))
        .otherwise(value.rlike(r"^[0-9().+/ -]+$") & digits.between(7, 15))
    )


def good_patterns(rows: DataFrame) -> DataFrame:
    """cue, kind and score of the patterns that hold after all rounds; rows come from occurrences().

    Edges join instances and cues. The instances of a cue and kind are all base entities next to it, of any
    kind, and the runs of that kind's shape. A cue scores the share of its distinct instances that
    are seeds (base entities of the kind) or believed; a run is believed as much as the best cue
    that holds (MIN_SCORE, and MIN_SEEDS distinct seeds). All steps are equi-joins and
    aggregates that combine before they shuffle; a cue is a key, so a frequent one is one row.
    """
    def edges_of(column: str) -> DataFrame:
        each = rows.select(F.explode(column).alias("o")).select("o.kind", "o.value", F.explode("o.contexts").alias("cue"))
        return each.distinct()

    base, other = edges_of("base"), edges_of("other")
    seeds = base.groupBy("cue", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= MIN_SEEDS)
    known = base.select("cue", "value").distinct().groupBy("cue").agg(F.count("*").alias("known"))
    seeds = staged(seeds.join(known, "cue"), "pii-seeds")
    edges = staged(other.join(seeds.select("cue", "kind"), ["cue", "kind"]), "pii-edges")
    runs = edges.groupBy("cue", "kind").agg(F.count("*").alias("runs"))
    counted = staged(seeds.join(runs, ["cue", "kind"], "left").withColumn("instances", F.col("known") + F.coalesce("runs", F.lit(0))), "pii-counted")
    scores = counted.withColumn("score", F.col("seeds") / F.col("instances"))
    for _ in range(ROUNDS):
        holding = scores.filter(F.col("score") >= MIN_SCORE).select("cue", "kind", "score")
        believed = edges.join(holding, ["cue", "kind"]).groupBy("value", "kind").agg(F.max("score").alias("belief"))
        gained = edges.join(believed, ["value", "kind"]).groupBy("cue", "kind").agg(F.sum("belief").alias("gained"))
        scores = staged(counted.join(gained, ["cue", "kind"], "left").withColumn(
            "score", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / F.col("instances")), "pii-patterns")
    return scores.filter(F.col("score") >= MIN_SCORE).select("cue", "kind", "score")


def find_entities(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, base and found for every row: arrays of kind (number in KINDS), start, end, value and cue.

    base holds the leftmost non-overlapping matches of each base pattern that pass its check (without a cue); found
    what the bootstrap adds, never overlapping base; of runs that overlap the one with the best cue. Spans are
    code points, ends exclusive. Null and empty texts have empty arrays; rows repeat as they come; other
    columns are not read, so their names can't clash; an empty table gives none.
    """
    rows = staged(occurrences(docs, text, doc_id), "pii-occurrences")
    good = good_patterns(rows).withColumnRenamed("kind", "good_kind").withColumnRenamed("cue", "good_cue")
    each = rows.select("doc_id", "text_hash", F.explode("other").alias("o")).select("*", F.explode("o.contexts").alias("cue"))
    fitting = each.join(good, (F.col("cue") == F.col("good_cue")) & (F.col("o.kind") == F.col("good_kind")))
    best = fitting.groupBy("doc_id", "text_hash", "o.kind", "o.start", "o.end", "o.value").agg(F.max(F.struct("score", "cue")).alias("best"))
    listed = best.groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
        F.collect_list(F.struct("kind", "start", "end", "value", F.col("best.cue").alias("cue"), F.col("best.score").alias("score"))).alias("all"))

    def beaten(s: Column, t: Column) -> Column:
        better = (t["score"] > s["score"]) | ((t["score"] == s["score"]) & (t["kind"] < s["kind"]))
        return (t["start"] < s["end"]) & (s["start"] < t["end"]) & (t["kind"] != s["kind"]) & better

    def entity(cue):
        return lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), cue(s).alias("cue"))

    kept = F.filter("all", lambda s: ~F.exists("all", lambda t: beaten(s, t)))
    found = listed.select("found_id", "found_hash", F.array_sort(F.transform(kept, entity(lambda s: s["cue"]))).alias("found"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["found_id"]) & (rows["text_hash"] == found["found_hash"]), "left")
    base = F.transform("base", entity(lambda s: F.lit(None).cast("string"))).cast(_ENTITIES)
    return joined.select("doc_id", base.alias("base"), F.coalesce("found", F.array().cast(_ENTITIES)).alias("found"))


def entity_table(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans of every row."""
    rows = find_entities(docs)

    def listed(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(number: int):
        return lambda s: s["kind"] == number

    counts = [F.size(F.filter("base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "found")).alias("spans"))
