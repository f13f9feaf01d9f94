"""Personal data by regular expressions and by bootstrapped contexts, with DataFrame
functions alone.

The base matches of four kinds are seeds. The words around a seed are lexical patterns:
the two words before it, the words on both sides, and the word before it if it ends like
a label. Other tokens that look like identifiers (they hold a digit or an @) are unseen
instances. Patterns and instances form a graph: a pattern's confidence in a kind is the
mean score of its instances, seeds of the kind scoring 1 and those of others 0; an unseen
instance scores the noisy-or of its patterns' confidences in kinds whose shape it has.
After some rounds, unseen instances in patterns of high confidence are spans too.
Competing kinds and other identifiers keep the confidence of everyday contexts low.

Only matches are shuffled, never texts; positions come from prefix sums over the matches
of a document. Copies of a mention are one edge of the graph.

Contexts are whole words, digits folded to one, wherever the text around a mention has
them, for seeds and unseen tokens alike.

Null text: empty, no spans. Texts and words of any length: whole. Repeated rows and null ids: a row of their own each. Empty
table: no rows. Overlapping base matches of different kinds all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.llm.tables import column, written

KINDS = ("email", "ip", "card", "phone")

# Equal to the plain expressions, but linear: a match can only begin where a run of its
# first characters does or the last match ended, and nothing is given back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Runs of numbers, and words with a digit or an @ in them.
    "other": r"(?<!\S)(?:\(?[0-9][0-9()./-]*+(?:\x20\(?[0-9][0-9()./-]*+)*+(?!\S)|[^\s0-9@]*+[0-9@]\S*+)",
}
# What a text must hold for an expression to be tried at all.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "other": "[0-9@]"}

# Shapes of unseen instances that a pattern may call its kind.
SHAPES = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^(?=.*[0-9])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f.]{0,15}$|^[0-9]{1,3}(?:[.-][0-9]{1,3}){3}$",
    "card": r"^(?:[0-9][ ./-]?){11,18}[0-9]$",
    "phone": r"^\(?(?:[0-9][ ()./-]*){6,14}[0-9]$",
}

ROUNDS = 3
MIN_SEEDS = 5  # distinct seeds that a pattern must have met
CONFIDENT = 0.8
LONG_WORD = 64  # code points; of a longer context word, a digest and the last letter stand for it
# Linear, too: words are tried from their first letters only.
_LAST_WORDS = r"(?<!\S)(?:\S++\s++)?\S++\s*+\z"
_FIRST_WORD = r"\A\s*+\S++"
_EDGE_LEFT, _EDGE_RIGHT = "\"'[{<", ".,;:!?\"']}>"


def _words(text: Column, which: str) -> Column:
    """The words that an expression finds, lower-cased, numbers alike, of bounded length."""
    found = F.filter(F.split(F.regexp_extract(F.lower(text), which, 0), r"\s+"), lambda w: w != "")

    def tidy(word: Column) -> Column:
        plain = F.regexp_replace(word, "[0-9]+", "0")
        short = F.concat(F.md5(plain), F.right(plain, F.lit(1)))
        return F.when(F.length(plain) > LONG_WORD, short).otherwise(plain)

    return F.transform(found, tidy)


def hits_of(text: Column, kind: str) -> Column:
    """All matches of a kind in order: gap (code points since the last one), hit, and
    the words around it.

    Words are looked for as far as the text before the last match but one and behind the
    next one, so that contexts do not end at a neighbour; the cost stays linear in the text.
    """
    pattern = PATTERNS[kind]
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")
    )

    def describe(gaps: Column, hits: Column, hit: Column, i: Column) -> Column:
        part = lambda of, n: F.coalesce(F.get(of, n), F.lit(""))
        # Parts of the text in order: gap 0, hit 0, gap 1, hit 1, ...
        before = F.concat(part(gaps, i - 2), part(hits, i - 2), part(gaps, i - 1), part(hits, i - 1), part(gaps, i))
        behind = F.concat(part(gaps, i + 1), part(hits, i + 1), part(gaps, i + 2))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.char_length(part(gaps, i)).alias("gap"),
            hit.alias("hit"),
            _words(before, _LAST_WORDS).alias("left"),
            _words(behind, _FIRST_WORD).alias("right"),
        )

    # An array of one, so that a text is split once and not again for every match.
    of_text = lambda p: F.transform(p["hits"], lambda hit, i: describe(p["gaps"], p["hits"], hit, i))
    found = F.flatten(F.transform(F.array(parts), of_text))
    none = F.array().cast("array<struct<kind:string,nth:int,gap:int,hit:string,left:array<string>,right:array<string>>>")
    return F.when(text.rlike(NEEDED[kind]), found).otherwise(none)


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    digit = lambda i: F.substr(digits, n - i + 1, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 1, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def holds(kind: Column, hit: Column) -> Column:
    """Whether a base match is kept."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    small = F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(False)
    )


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, hits): one row for each of ``docs``, numbered, with its matches."""
    given = docs.select(
        column(docs, doc_id).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text")
    )
    hits = F.concat(*[hits_of(F.col("text"), kind) for kind in PATTERNS])
    return written(given.select(F.monotonically_increasing_id().alias("row"), "doc_id", hits.alias("hits")), "mentions")


def located(rows: DataFrame) -> DataFrame:
    """Every base match that holds and every other token clear of these, with its place."""
    each = rows.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    by_kind = Window.partitionBy("row", "kind").orderBy("nth")
    length = F.char_length("hit")
    end = F.sum(F.col("gap") + length).over(by_kind)
    placed = each.select("*", end.alias("end")).withColumn("start", F.col("end") - length)
    placed = placed.withColumn("base", holds(F.col("kind"), F.col("hit"))).where("base OR kind = 'other'")
    # Of other tokens, the part between marks at their edges.
    left = length - F.char_length(F.ltrim("hit", F.lit(_EDGE_LEFT)))
    right = length - F.char_length(F.rtrim("hit", F.lit(_EDGE_RIGHT)))
    other = ~F.col("base")
    placed = placed.withColumns(
        {
            "start": F.col("start") + F.when(other, left).otherwise(0),
            "end": F.col("end") - F.when(other, right).otherwise(0),
            "hit": F.when(other, F.rtrim(F.ltrim("hit", F.lit(_EDGE_LEFT)), F.lit(_EDGE_RIGHT))).otherwise(F.col("hit")),
        }
    )
    order = Window.partitionBy("row").orderBy("start", F.col("base").desc(), "end")
    ahead = order.rowsBetween(1, Window.unboundedFollowing)
    last = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Starts ascend, so the next base match is the first one ahead.
    coming = F.first(F.when(F.col("base"), F.col("start")), ignorenulls=True).over(ahead)
    clear = (F.coalesce(last, F.lit(-1)) <= F.col("start")) & (F.coalesce(coming, F.lit(2**62)) >= F.col("end"))
    kept = placed.withColumn("clear", clear).where(F.col("base") | (F.col("clear") & (F.col("hit") != "")))
    return kept.select("row", "kind", "base", "start", "end", "hit", "left", "right")


def lexical_patterns(left: Column, right: Column) -> Column:
    """The patterns that a mention supports."""
    two = F.when(F.size(left) == 2, F.concat(F.lit("2 "), F.array_join(left, " ")))
    last = F.try_element_at(left, F.lit(-1))
    label = F.when(last.rlike("[:=#]$"), F.concat(F.lit("1 "), last))
    sides = F.when((F.size(left) > 0) & (F.size(right) > 0), F.concat(F.lit("b "), last, F.lit(" _ "), right[0]))
    return F.array_compact(F.array(two, label, sides))


def shape_kinds(hit: Column) -> Column:
    return F.array_compact(F.array(*[F.when(hit.rlike(shape), F.lit(kind)) for kind, shape in SHAPES.items()]))


def confident_patterns(spans: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that may discover spans."""
    edges = spans.select(
        F.explode(lexical_patterns(F.col("left"), F.col("right"))).alias("pattern"),
        F.when(F.col("base"), F.col("kind")).alias("seed"),
        F.lower("hit").alias("instance"),
    ).distinct()
    edges = written(edges, "pattern-edges")
    seeds = edges.where("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(
        F.count(F.lit(1)).alias("seeds")
    )
    seeds = seeds.where(F.col("seeds") >= MIN_SEEDS)
    totals = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("instances"))
    known = written(seeds.join(totals, "pattern"), "patterns")
    unseen = edges.where("seed IS NULL").join(known.select("pattern").distinct(), "pattern", "left_semi")
    unseen = written(
        unseen.select("pattern", "instance", F.explode(shape_kinds(F.col("instance"))).alias("kind")), "unseen"
    )
    confidence = known.select("pattern", "kind", (F.col("seeds") / F.col("instances")).alias("confidence"))
    for _ in range(ROUNDS):
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        scores = unseen.join(confidence, ["pattern", "kind"]).groupBy("instance", "kind").agg(
            (1 - F.exp(doubt)).alias("score")
        )
        gained = unseen.join(scores, ["instance", "kind"]).groupBy("pattern", "kind").agg(
            F.sum("score").alias("gained")
        )
        mean = (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / F.col("instances")
        confidence = written(
            known.join(gained, ["pattern", "kind"], "left").select("pattern", "kind", mean.alias("confidence")),
            "confidence",
        )
    return confidence.where(F.col("confidence") >= CONFIDENT)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for every row: an array of kind, start, end, base, by kind and start."""
    rows = mentions(docs, doc_id, text)
    spans = written(located(rows), "mention-spans")
    trusted = confident_patterns(spans)
    met = spans.where("NOT base").select(
        "row", "start", "end", shape_kinds(F.col("hit")).alias("kinds"),
        F.explode(lexical_patterns(F.col("left"), F.col("right"))).alias("pattern"),
    )
    best = F.max(F.struct("confidence", "kind")).alias("best")
    found = (
        met.join(trusted, "pattern")
        .where(F.array_contains("kinds", F.col("kind")))
        .groupBy("row", "start", "end")
        .agg(best)
        .select("row", "best.kind", "start", "end", F.lit(False).alias("base"))
    )
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("rank")
    all_spans = spans.where("base").select("row", "kind", "start", "end", "base").union(found)
    grouped = all_spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(rank, "start", "end", "kind", "base"))).alias("spans")
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    tidy = F.transform("spans", lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"]))
    return rows.select("row", "doc_id").join(grouped, "row", "left").select("doc_id", F.coalesce(tidy, none).alias("spans"))
