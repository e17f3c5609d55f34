"""Personal data by base patterns and bootstrapped contextual extraction, in Spark SQL functions only.

Base spans come from four fixed patterns. The bootstrap then works on a
graph of lexical patterns and instances:

* an instance is a base span's value, or an identifier-like token (letters,
  digits and joiners, with a digit) outside all base spans;
* a pattern is the word before an instance with the marks between them
  (``: = #`` and an opening quote or bracket), white space left out; its total
  is how often word and marks stand together in all texts.

Seeds are the base spans' values, and tokens whose shape alone marks an
identifier (long, with many digits among letters). Scores go round the graph
a few times: a pattern's score is the sum of its instances' scores over its
total plus a prior, an instance's score is 1 - product of (1 - score) of its
patterns; seeds stay at 1. Tokens after a pattern that is confident and has
enough different seeds become spans of kind ``id``, and so does every other
occurrence of a token that confident patterns support. A seed's shape alone
makes no span.

Offsets are code points, the end exclusive. Defined results: a null text is
empty and has no spans; repeated rows get equal results; a null key is an
ordinary value. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.llm.frames import positional
from clvspark.session import materialize

#: The kinds in their order; ``id`` is what the bootstrap finds.
KINDS = ("email", "ip", "card", "phone", "id")

# The stated patterns. Possessive repeats and the start guards change no match; they keep a
# search linear on long runs: inside a run every later start would fail as the first did.
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TOKEN = r"(?<![A-Za-z0-9_@.+/-])[A-Za-z0-9_+/-]++(?:[.@][A-Za-z0-9_+/-]++)*+"
#: Tokens that are seeds by shape: sixteen characters or more, six digits and three letters among them.
_SEED_SHAPE = r"^(?=(?:[^0-9]*[0-9]){6})(?=(?:[^A-Za-z]*[A-Za-z]){3})[A-Za-z0-9_-]{16,}$"
_MARKS = r"\s*+[:=#]*+\s*+[\"'(<\[]?"
_CONTEXT = r"[\p{L}_]++" + _MARKS
_BEFORE_CHARS = 48


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable is bound, a repeated expression is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: str, pattern: str) -> Column:
    """array<struct<start, end, m>> of a pattern's leftmost non-overlapping matches in column ``text``.

    A split gives the gaps between the matches, so the offsets are running
    sums of lengths. They are taken in chunks, which keeps the work for n
    matches near n * 256 instead of n * n.
    """
    chunk = 256

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda s, x: s + x["gap"] + x["n"])

    def in_chunks(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / chunk).cast("int")),
                           lambda c: F.slice(parts, c * chunk + 1, F.lit(chunk)))

    def placed(chunks: Column, sums: Column) -> Column:
        def one_chunk(part: Column, number: Column) -> Column:
            before = F.aggregate(F.slice(sums, F.lit(1), number), F.lit(0), lambda s, x: s + x)
            return let(before, lambda at: F.transform(part, lambda x, i: let(
                at + total(F.slice(part, F.lit(1), i + 1)),
                lambda end: F.struct((end - x["n"]).alias("start"), end.alias("end"), x["m"].alias("m")))))
        return F.flatten(F.transform(chunks, one_chunk))

    def located(found: Column) -> Column:
        parts = F.zip_with(found, F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(found)),
                           lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m).alias("n"), m.alias("m")))
        return F.when(F.size(found) > 0, let(parts, lambda p: let(in_chunks(p), lambda chunks: let(
            F.transform(chunks, total), lambda sums: placed(chunks, sums))))).otherwise(
            F.array().cast("array<struct<start:int,end:int,m:string>>"))

    return let(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), located)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(small(p)) <= 3) & (F.lpad(small(p), 3, "0") <= "255"))
    if kind == "card":
        return F.length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _base(text: str) -> Column:
    """All base spans of a text, by start, then kind."""
    hints = {"email": F.col(text).contains("@"), "ip": F.col(text).rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
             "card": F.col(text).rlike("[0-9](?:[ -]?[0-9]){13}"), "phone": F.col(text).rlike(r"\+[0-9]")}
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
    none = F.array().cast("array<struct<start:int,kind:int,end:int,m:string>>")

    def of(kind: str) -> Column:
        good = F.filter(matches(text, patterns[kind]), lambda x: _valid(kind, x["m"]))
        return F.when(hints[kind], F.transform(good, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"),
            x["m"].alias("m")))).otherwise(none)

    found = [of(kind) for kind in patterns]
    return F.when(F.col(text).rlike("[0-9@]"), F.array_sort(F.concat(*found))).otherwise(none)


def _pattern_before(text: str, start: Column) -> Column:
    """The word in front of code point ``start`` with the marks in between, lower case, white space left out; or empty.

    It is sought in a short window; the whole text before ``start`` is read only where the window is all white space
    and marks, or its word begins with it.
    """
    size = F.least(start, F.lit(_BEFORE_CHARS))
    window = F.substring(F.col(text), start - size + 1, size)

    def found(part: Column) -> Column:
        return F.regexp_extract(part, _CONTEXT + "$", 0)

    def checked(short: Column, part: Column) -> Column:
        cut = (size < start) & ((F.length(short) == size) | part.rlike(r"^[\s:=#\"'(<\[]*$"))
        return F.when(cut, found(F.substring(F.col(text), F.lit(1), start))).otherwise(short)

    return F.lower(F.regexp_replace(let(window, lambda part: let(found(part), lambda short: checked(short, part))), r"\s+", ""))


def _tokens(text: str, base: Column, min_chars: int) -> Column:
    """Identifier-like tokens outside the base spans, with the pattern before each and whether their shape is a seed's."""
    raw = F.filter(matches(text, _TOKEN), lambda x: (x["end"] - x["start"] >= min_chars) & x["m"].rlike("[0-9]"))
    free = F.filter(raw, lambda x: ~F.exists(base, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])))
    return F.transform(free, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("value"),
        _pattern_before(text, x["start"]).alias("word"), x["m"].rlike(_SEED_SHAPE).alias("shaped")))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = 3, confidence: float = 0.5,
          min_seeds: int = 3, prior: float = 2.0, min_chars: int = 6) -> DataFrame:
    """(key, digest, spans) of every row: spans is array<struct<start, kind, end>>, by start, then kind.

    ``kind`` indexes ``KINDS``; ``digest`` is xxhash64 of the text and tells
    rows that share a key apart.
    """
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start:int,end:int,value:string,word:string,shaped:boolean>>")

    def parts(base: Column) -> Column:
        tokens = F.when(F.col("text").rlike("[0-9]"), _tokens("text", base, min_chars)).otherwise(none)
        return F.struct(
            F.transform(base, lambda s: F.struct(s["start"], s["kind"], s["end"])).alias("base"),
            F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("value"),
                                                 _pattern_before("text", s["start"]).alias("word"))).alias("seeds"),
            tokens.alias("tokens"))

    found = materialize(source.select("key", F.xxhash64("text").alias("digest"),
                                      F.inline(F.array(let(_base("text"), parts)))))

    occurrences = found.select(F.explode(F.concat(
        F.transform("seeds", lambda s: F.struct(s["word"], s["value"], F.lit(1.0).alias("seed"))),
        F.transform("tokens", lambda s: F.struct(s["word"], s["value"], s["shaped"].cast("double").alias("seed"))))).alias("o")).select("o.*")
    graph = materialize(occurrences.filter("word <> ''").groupBy("word", "value").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))
    # only patterns that precede seeds can become confident; their totals count all texts
    promising = materialize(graph.filter("seed = 1").groupBy("word").agg(
        F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= min_seeds))
    contexts = F.explode(F.regexp_extract_all("text", F.lit(_CONTEXT), F.lit(0)))
    uses = source.select(contexts.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = uses.groupBy(F.lower(F.regexp_replace("word", r"\s+", "")).alias("word")).agg(F.sum("n").alias("total"))
    patterns = materialize(promising.join(counts, "word").select("word", "seeds", "total"))

    edges = materialize(graph.join(patterns, "word"))
    scored = edges.withColumn("score", F.col("seed"))
    for _ in range(rounds):
        strength = scored.groupBy("word").agg(
            (F.sum(F.col("score") * F.col("n")) / (F.max("total") + prior)).alias("strength"))
        weighed = scored.select("word", "value", "seed", "n", "total").join(strength, "word")
        support = 1 - F.exp(F.sum(F.log1p(-F.least("strength", F.lit(0.999999)))))
        instance = weighed.groupBy("value").agg(support.alias("support"), F.greatest(F.max("seed"), support).alias("score"))
        scored = materialize(weighed.join(instance, "value"))
    sure_words = scored.filter(F.col("strength") >= confidence).select("word").distinct()
    sure_values = scored.filter(F.col("support") >= confidence).select("value").distinct()

    tokens = found.select("key", "digest", F.explode("tokens").alias("t")).select("key", "digest", "t.*")
    more = tokens.join(sure_words, "word", "left_semi").select("key", "digest", "start", "end").unionByName(
        tokens.join(sure_values, "value", "left_semi").select("key", "digest", "start", "end"))
    extra = more.groupBy("key", "digest").agg(F.collect_set(F.struct(
        "start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("extra"))
    joined = found.select("key", "digest", "base").join(
        extra.withColumnsRenamed({"key": "k", "digest": "d"}),
        F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")), "left")
    return joined.select(F.col("key").alias(key), "digest", F.array_sort(
        F.concat("base", F.coalesce("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans"))


def written(spans_column: str, kinds: int = len(KINDS)) -> Column:
    """``kind:start:end`` of the first ``kinds`` kinds, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    chosen = F.filter(spans_column, lambda s: s["kind"] < kinds)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans_column: str, kind: str) -> Column:
    return F.size(F.filter(spans_column, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    found = spans(docs, key, text, **options).filter(F.size("spans") > 0).dropDuplicates([key, "digest"]).select(
        F.col(key).alias("k"), F.col("digest").alias("d"), F.col("spans").alias("found"))
    names = positional(docs)
    own_key, own_text = names[docs.columns.index(key)], names[docs.columns.index(text)]
    joined = docs.toDF(*names).join(
        found, F.col(own_key).eqNullSafe(F.col("k")) & (F.xxhash64(own_text) == F.col("d")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(F.col(own_text), acc["at"] + 1, s["start"] - acc["at"]), F.get(kinds, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("found", start, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col(own_text), acc["at"] + 1, F.length(own_text))))
    return joined.withColumn(own_text, F.when(F.col("found").isNotNull(), done).otherwise(F.col(own_text))).select(
        *names).toDF(*docs.columns)
