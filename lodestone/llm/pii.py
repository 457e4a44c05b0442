"""Personal data: patterned seeds, and identifiers found by bootstrapped contexts and forms. DataFrame functions only.

Seeds are e-mail addresses, IPv4 addresses, payment card numbers (Luhn) and international phone numbers, found by patterns and checks;
secrets (keys and passwords) are seeds of a further kind, which is reported apart. An instance is a token with a digit or an @, or up to
GROUP neighbouring tokens of digits and phone signs. It has lexical patterns of two families: its context (the word before it, the two
words before it, the words on both sides, the word after it) and its form (the exact shape of its characters, and the shape without
the runs' lengths, each with the outcome of the checks of cards, addresses and numbers of digits).

On the graph of patterns and instances, in each round a pattern's confidence is known / (all + 1) over its distinct instances, where
known ones are of any kind; a pattern is taken if that is at least LEAST_CONFIDENCE and, times log2(1 + known), at least LEAST_WEIGHT.
An instance's score is the noisy-or of its best pattern of each family; with CONFIDENCE or more it is known in the next round. So a
form with few seeds needs a context that agrees, and a pattern that many seeds share suffices alone. What is known after ROUNDS rounds
and no seed is a new span if it has LEAST_DIGITS digits or an @. Its kind is the one that its form allows (an @: email; four parts of
at most 255: ip; 16 to 19 digits that pass Luhn: card; LEAST_DIGITS to 15 digits and phone signs only: phone), else its best pattern's, if
that is email and it has an @, or phone and it has no more than 15 digits; else it is no span. Of new spans that overlap, the first longest stays; none overlaps a seed.

Spans count code points; white space that parts tokens is ASCII. Null text is empty and has none. Repeated rows have equal spans. An empty
table gives an empty table. Words of over 64 characters stand in patterns by their SHA-256; nothing is cut. Rows are known by numbers
given when the scan is written, never by a hash of their text, so copies of a text don't meet in one task.
The regular expressions are possessive forms of the plain ones, so that long runs take linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    SECRET: r"\bAKIA[0-9A-Z]{16}\b|\b(?i:password|passwd|pwd|secret|token|api[_-]?key) ?[=:] ?[\"']?[A-Za-z0-9+/_-]{12,}+[\"']?",
}
#: What a text must hold for a pattern to match.
MARKS = {"email": "@", "ip": ".", "card": "", "phone": "+", SECRET: ""}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Tokens of phone signs: all but the last of a group, and the last, after which other signs may follow.
INNER, LAST = r"^[+(]*[0-9][0-9()/-]*$", r"^[+(]*[0-9][0-9()/-]*[^A-Za-z0-9]*$"
ROUNDS, LEAST_CONFIDENCE, LEAST_WEIGHT, CONFIDENCE, LEAST_DIGITS, GROUP = 3, 0.5, 1.0, 0.8, 5, 4
_PATTERN = "array<struct<family:string,pattern:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(_digits(value)), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _parts(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(F.try_to_number(F.right(x, F.lit(3)), F.lit("999")), F.lit(0)) <= 255))


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return _parts(value)
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(value)).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _scan(docs: DataFrame, *carried: Column) -> DataFrame:
    """For each row its number, the patterns' matches, and the lengths of what stands before each; for tokens also the words next to them.

    `carried` are further columns; their names don't clash with those of the scan, as they are put into structs.
    """
    text = F.coalesce("text", F.lit(""))
    out = docs.select(*carried, "doc_id", F.monotonically_increasing_id().alias("row"), text.alias("t"), (text.rlike("[0-9@]") | F.contains(text, F.lit("="))).alias("any"))
    found = []
    for kind in (*KINDS, SECRET, "token"):
        pattern = PATTERNS.get(kind, TOKEN)
        has = F.col("any") & F.contains("t", F.lit(MARKS.get(kind, "")))
        gaps = F.split("t", pattern, -1)
        found.append(F.when(has, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).alias(kind))
        if kind == "token":
            # whole words: the last two before a token, the first after it
            spaced = F.transform(gaps, lambda x: F.struct(F.length(x).alias("n"), F.trim(F.regexp_replace(x, r"\s+", " ")).alias("w")))
            around = F.transform(spaced, lambda x: F.struct(x["n"].alias("n"), F.substring_index(x["w"], " ", -2).alias("before"), F.substring_index(x["w"], " ", 1).alias("after")))
            found.append(F.when(has, around).alias("token_gaps"))
        else:
            found.append(F.when(has, F.transform(gaps, lambda x: F.length(x))).alias(f"{kind}_gaps"))
    return out.select(*[c for c in out.columns if c not in ("t", "any")], *found)


def _with_matches(scanned: DataFrame) -> DataFrame:
    some = F.coalesce(*[F.when(F.size(k) > 0, True) for k in (*KINDS, SECRET, "token")], F.lit(False))
    return scanned.where(some)


def seed_spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the matches that pass their checks."""
    out = None
    for kind in (*KINDS, SECRET):
        zipped = F.arrays_zip(F.col(kind).alias("m"), F.slice(f"{kind}_gaps", 1, F.greatest(F.size(kind), F.lit(0))).alias("g"))
        rows = scanned.where(F.size(kind) > 0).select("row", F.posexplode(zipped).alias("i", "x")).select("row", "i", F.col("x.m").alias("value"), F.col("x.g").alias("gap"))
        end = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("row").orderBy("i")).cast("int")
        rows = rows.withColumn("end", end).where(_valid(kind, F.col("value")))
        rows = rows.select("row", F.lit(kind).alias("kind"), (F.col("end") - F.length("value")).alias("start"), "end")
        out = rows if out is None else out.unionByName(rows)
    return out


def _shape(value: Column) -> Column:
    out = value
    for pattern, sign in (("[0-9]", "9"), ("[A-Z]", "A"), ("[a-z]", "a"), (r"[^\x00-\x7F]", "o")):
        out = F.regexp_replace(out, pattern, sign)
    return out


def _short(word: Column) -> Column:
    return F.when(F.length(word) > 64, F.sha2(word, 256)).otherwise(word)


def _checks(value: Column) -> Column:
    """What the kinds' checks say of an instance, as signs of its form."""
    n = F.length(_digits(value))
    card = F.when(value.rlike("^[0-9][0-9 -]*$") & n.between(16, 19), F.when(_luhn(value), "+luhn").otherwise("-luhn")).otherwise("")
    ip = F.when(value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), F.when(_parts(value), "+parts").otherwise("-parts")).otherwise("")
    phone = F.when(value.startswith("+"), F.when(n.between(8, 15), "+digits").otherwise("-digits")).otherwise("")
    return F.concat(card, ip, phone)


def _fitting(value: Column) -> Column:
    """The kind that an instance's form allows."""
    n = F.length(_digits(value))
    return (
        F.when(F.contains(value, F.lit("@")), F.when(value.rlike(r"^[^\s@]+@[^\s@]+$"), "email"))
        .when(value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), F.when(_parts(value), "ip"))
        .when(value.rlike("^[0-9][0-9 -]*$") & n.between(16, 19), F.when(_luhn(value), "card"))
        .when(value.rlike(r"^[+(]?[0-9][0-9 ()./-]*$") & n.between(LEAST_DIGITS, 15), "phone")
    )


def _instances(scanned: DataFrame, seeds: DataFrame) -> DataFrame:
    """(row, start, end, kind, instance, patterns): tokens and groups of tokens that are seeds (kind is set) or touch none."""
    gap = lambda i: F.transform(F.slice("token_gaps", i, F.size("token")), lambda x: x)
    zipped = F.arrays_zip(F.col("token").alias("v"), gap(1).alias("g"), gap(2).alias("h"))
    rows = scanned.where(F.size("token") > 0).select("row", F.posexplode(zipped).alias("i", "x")).select("row", "i", "x.v", "x.g", "x.h")
    by = Window.partitionBy("row").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("g.n") + F.length("v")).over(by).cast("int")).withColumn("start", F.col("end") - F.length("v"))
    words = F.when(F.col("g.before") != "", F.split(F.lower("g.before"), " ")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("words", words).withColumn("sign", F.concat(F.lit("#"), _short(_shape(F.col("v")))))
    rows = rows.withColumn("left", F.coalesce(F.try_element_at("words", F.lit(-1)), F.lag("sign").over(by)))
    rows = rows.withColumn("second", F.coalesce(F.try_element_at("words", F.lit(-2)), F.when(F.size("words") == 1, F.lag("sign").over(by)), F.lag("left").over(by)))
    rows = rows.withColumn("right", F.coalesce(F.nullif(F.lower("h.after"), F.lit("")), F.lead("sign").over(by)))
    inner, last, next_to = F.col("v").rlike(INNER), F.col("v").rlike(LAST), (F.col("g.n") == 1) & (F.col("g.before") == "")
    rows = rows.withColumns({"inner": inner, "last": last, "near": next_to})
    trailing = lambda x: F.regexp_replace(x, r"[^A-Za-z0-9]+$", "")
    single = F.regexp_extract("v", r"^[^A-Za-z0-9+]*", 0)
    group_lead = F.regexp_extract("v", r"^[^0-9+(]*", 0)
    core = trailing(F.substring(F.col("v"), F.length(single) + 1, F.length("v")))
    found = [F.struct((F.col("start") + F.length(single)).alias("start"), core.alias("core"), F.col("right").alias("right"))]
    chain, text = F.col("inner"), F.col("v")
    for k in range(1, GROUP):
        lead = lambda c, k=k: F.lead(c, k).over(by)
        text = F.concat(text, F.lit(" "), lead("v"))
        ok = chain & lead("near") & lead("last")
        own = trailing(F.substring(text, F.length(group_lead) + 1, F.length(text)))
        found.append(F.when(ok, F.struct((F.col("start") + F.length(group_lead)).alias("start"), own.alias("core"), lead("right").alias("right"))))
        chain = chain & lead("near") & lead("inner")
    # the windows' columns first, then one row for each instance
    rows = rows.select("row", "left", "second", F.array(*found).alias("found"))
    rows = rows.select("row", "left", "second", F.explode(F.filter("found", lambda x: x.isNotNull())).alias("x")).select("row", "left", "second", "x.*").where("core <> ''")
    rows = rows.withColumn("end", F.col("start") + F.length("core"))
    # a seed with the same bounds names an instance; any other seed that it touches rules it out
    spans = seeds.select("row", "start", "end", "kind")
    none = F.lit(None).cast("string")
    both = rows.select("row", "start", "end", "core", "left", "second", "right", none.alias("kind"), F.lit(1).alias("o"))
    both = both.unionByName(spans.select("row", "start", "end", none.alias("core"), none.alias("left"), none.alias("second"), none.alias("right"), "kind", F.lit(0).alias("o")))
    order = Window.partitionBy("row").orderBy("start", "o")
    seed = F.col("o") == 0
    reach = F.max(F.when(seed, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # backwards, as a running minimum takes linear time and a frame to the end doesn't
    backwards = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("o"))
    after = F.min(F.when(seed, F.col("start"))).over(backwards.rowsBetween(Window.unboundedPreceding, -1))
    same = F.max("kind").over(Window.partitionBy("row", "start", "end"))
    both = both.withColumns({"reach": reach, "after": after, "same": same}).where("o = 1")
    touched = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("after") < F.col("end"), F.lit(False))
    both = both.where(F.col("same").isNotNull() | ~touched)
    # secrets are no seeds of the graph
    both = both.where(F.coalesce(F.col("same") != SECRET, F.lit(True)))
    left, second, right = (_short(F.col(c)) for c in ("left", "second", "right"))
    signs = F.concat(F.lit(" "), _checks(F.col("core")))
    shape = _short(_shape(F.col("core")))
    loose = _short(F.regexp_replace(_shape(F.col("core")), r"(.)\1+", "$1"))
    contexts = [F.concat(F.lit("1 "), left), F.concat(F.lit("2 "), second, F.lit(" "), left), F.concat(F.lit("3 "), left, F.lit(" _ "), right)]
    pattern = lambda family, x: F.when(x.isNotNull(), F.struct(F.lit(family).alias("family"), x.alias("pattern")))
    patterns = F.filter(F.array(*[pattern("context", x) for x in contexts], pattern("form", F.concat(F.lit("5 "), shape, signs)), pattern("form", F.concat(F.lit("6 "), loose, signs))), lambda x: x.isNotNull())
    return both.select("row", "start", "end", F.col("same").alias("kind"), "core", _short(F.col("core")).alias("instance"), patterns.cast(_PATTERN).alias("patterns"))


def bootstrap(
    instances: DataFrame, *, rounds: int = ROUNDS, least_confidence: float = LEAST_CONFIDENCE, least_weight: float = LEAST_WEIGHT, confidence: float = CONFIDENCE,
) -> tuple[DataFrame, DataFrame]:
    """The patterns taken after the last round (pattern, kind, known, conf), and what is known by them and is no seed (instance, kind, score)."""
    edges = materialize(instances.select(F.explode("patterns").alias("p"), "instance").select("p.family", "p.pattern", "instance").distinct(), "pii-edges")
    sizes = materialize(edges.groupBy("pattern").agg(F.count("*").alias("all")), "pii-sizes")
    seeds = instances.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"))
    seeds = materialize(seeds, "pii-known")
    known, taken, found = seeds, None, None
    for _ in range(rounds):
        votes = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
        taken = votes.groupBy("pattern").agg(F.sum("n").alias("known"), F.max_by("kind", F.struct("n", "kind")).alias("kind")).join(sizes, "pattern")
        taken = taken.withColumn("conf", F.col("known") / (F.col("all") + 1))
        taken = taken.where((F.col("conf") >= least_confidence) & (F.col("conf") * F.log2(1 + F.col("known")) >= least_weight))
        taken = materialize(taken.select("pattern", "kind", "known", "conf"), "pii-patterns")
        best = edges.join(taken, "pattern").groupBy("instance", "family").agg(F.max("conf").alias("conf"), F.max_by("kind", F.struct("conf", "kind")).alias("kind"))
        score = (1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("score")
        scored = best.groupBy("instance").agg(score, F.max_by("kind", F.struct("conf", "kind")).alias("kind")).where(F.col("score") >= confidence)
        found = materialize(scored.join(seeds.select("instance"), "instance", "left_anti").select("instance", "kind", "score"), "pii-found")
        known = seeds.unionByName(found.select("instance", "kind"))
    return taken, found


def _added(instances: DataFrame, found: DataFrame) -> DataFrame:
    """(row, kind, start, end) of new spans: those that are known, with a kind that their form allows, the first longest of overlapping ones."""
    fitting = _fitting(F.col("core"))
    digits = F.length(_digits(F.col("core")))
    rows = instances.where("kind is null").where((digits >= LEAST_DIGITS) | F.contains("core", F.lit("@"))).drop("kind").join(found, "instance")
    mail = F.contains("core", F.lit("@"))
    else_kind = F.when(((F.col("kind") == "email") & mail) | ((F.col("kind") == "phone") & ~mail & (digits <= 15)), F.col("kind"))
    rows = rows.withColumn("kind", F.coalesce(fitting, else_kind)).where("kind is not null")
    longest = Window.partitionBy("row", "start").orderBy(F.desc("end"))
    rows = rows.withColumn("rank", F.row_number().over(longest)).where("rank = 1")
    before = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).where("before is null or before <= start")
    return rows.select("row", "kind", "start", "end")


def _spans_of(scanned: DataFrame, **settings) -> DataFrame:
    texts = _with_matches(scanned)
    seeds = materialize(seed_spans(texts), "pii-seeds")
    instances = materialize(_instances(texts, seeds), "pii-instances")
    _, found = bootstrap(instances, **settings)
    return seeds.withColumn("base", F.lit(True)).unionByName(_added(instances, found).withColumn("base", F.lit(False)))


def find_spans(docs: DataFrame, **settings) -> tuple[DataFrame, DataFrame]:
    """The scan (doc_id, row, matches), and spans (row, kind, start, end, base) of its rows."""
    scanned = materialize(_scan(docs.select("doc_id", "text")), "pii-scan")
    return scanned, _spans_of(scanned, **settings)


def span_digest(docs: DataFrame, **settings) -> DataFrame:
    """One row for each document: doc_id, the numbers of seeds by kind, base (the seeds), spans (all) and secrets, as kind:start:end by kind and start."""
    scanned, spans = find_spans(docs, **settings)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("o")
    one = F.struct(order, "start", "end", F.concat_ws(":", "kind", "start", "end").alias("s"))
    joined = lambda x: F.array_join(F.transform(F.array_sort(x), lambda s: s["s"]), ",")
    own = F.col("kind") != SECRET
    texts = spans.groupBy("row").agg(
        *[F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}") for k in (*KINDS, SECRET)],
        joined(F.collect_list(F.when(F.col("base") & own, one))).alias("base"), joined(F.collect_list(F.when(own, one))).alias("spans"),
        joined(F.collect_list(F.when(~own, one))).alias("secrets"), F.count_if(own).alias("n_spans"),
    )
    rows = scanned.select("doc_id", "row").join(texts, "row", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in (*[f"n_{k}" for k in (*KINDS, SECRET)], "n_spans")]
    return rows.select("doc_id", *counts, *[F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans", "secrets")])


def redact(docs: DataFrame, **settings) -> DataFrame:
    """The documents with each span (secrets too) replaced by its kind in brackets; overlapping spans become one. All columns stay; null text stays null.

    The documents are written once with their scan; those without any match come back from there as they are.
    """
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    scanned = materialize(_scan(docs, whole), "pii-scan")
    spans = _spans_of(scanned.drop("doc"), **settings)
    by_start = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.coalesce(F.col("start") >= reach, F.lit(True)), 1).otherwise(0)).withColumn("part", F.sum("new").over(by_start))
    merged = spans.groupBy("row", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end")).alias("kind"))
    cuts = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    text = F.col("doc.text")
    start = lambda i: F.when(i == 0, 0).otherwise(F.get("cuts", i - 1)["end"])
    pieces = F.transform("cuts", lambda c, i: F.concat(F.substring(text, start(i) + 1, c["start"] - start(i)), F.lit("["), F.upper(c["kind"]), F.lit("]")))
    last = F.substring(text, F.element_at("cuts", -1)["end"] + 1, F.length(text))
    cut = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), last))
    some = _with_matches(scanned)
    changed = some.select("row", "doc").join(cuts, "row", "left").select(F.col("doc").withField("text", cut).alias("doc"))
    any_match = F.coalesce(*[F.when(F.size(k) > 0, True) for k in (*KINDS, SECRET, "token")], F.lit(False))
    return scanned.where(~any_match).select("doc").unionByName(changed).select("doc.*")
