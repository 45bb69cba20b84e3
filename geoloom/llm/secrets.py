"""Secret scans: patterns, and random strings by two character Markov models.

One model is trained on labelled random strings, the other on labelled ordinary
identifiers. A long token whose log-likelihood ratio speaks for the first is a
secret. All in DataFrame functions.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, table
from geoloom.llm.matches import running, steps

#: The contract's base patterns, in its order.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: What must be in a text for a kind to be in it; spares the rest of the work.
MAY = {"assign": PATTERNS["assign"], "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
TOKEN, SHORTEST = r"[A-Za-z0-9+/_=-]{16,}", 16
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Words that the default ordinary identifiers are made of.
COMMON = (
    "account action active address admin allow application array article async attribute author average backend balance base batch before border bottom browser buffer build button cache callback "
    "category center change channel check child class client close cluster code collection color column command comment commit common component config connection constant content context control "
    "convert cookie counter country create current cursor customer data database date debug default delete description detail device dialog directory display document domain download dropdown duration "
    "element email enable encoding engine entry error event example exception execute export factory feature field file filter final folder footer format frame function gateway global group handler "
    "header height history host identifier image import index input insert instance integer internal invoice item join keyboard label language layout length level library license limit listener loader "
    "local location logger manager master matrix message method model module monitor name network node notification number object option order output package page parameter parent parser partition path "
    "payment pipeline pointer policy position primary process product profile project property provider query queue range record reference region register remote render report request resource response "
    "result return schedule schema scope screen search section select server service session setting shape shipping signal size snapshot source stack standard status storage stream string style summary "
    "support switch system table target template thread timeout title total track transaction transfer transform trigger type undefined unique update upload user utility validate value variable vector "
    "version view visible warehouse warning widget width window worker workspace writer zone"
).split()


def default_samples(spark: SparkSession, n: int = 8000) -> DataFrame:
    """Labelled samples (text, label, kind, part), made by rule: 1 for strings of hash digits in usual encodings, 0 for identifiers of common words, numbers and the like.

    part 0 and 1 are for the models, 2 for the threshold, 3 is held out.
    """
    draw = lambda k, below: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(below)).cast("int")
    ids = spark.range(n).withColumn("digest", F.unhex(F.concat(F.sha2(F.col("id").cast("string"), 256), F.sha2(F.concat(F.lit("+"), F.col("id").cast("string")), 256))))
    encoded, plain = F.base64("digest"), F.regexp_replace(F.base64("digest"), "[+/=]", "")
    small = F.lower(plain)
    randoms = {
        "base64": encoded, "base64 for addresses": F.translate(encoded, "+/", "-_"), "letters and digits": plain, "upper case and digits": F.upper(plain), "lower case and digits": small,
        "lower case": F.translate(small, "0123456789", ""), "hexadecimal": F.lower(F.hex("digest")),
    }
    words = F.array(*[F.lit(w) for w in COMMON])
    parts = F.slice(F.array(*[F.element_at(words, draw(k, len(COMMON)) + 1) for k in range(5)]), 1, (F.lit(2) + draw(9, 4)).cast("int"))
    camel = F.array_join(F.transform(parts, F.initcap), "")
    join = lambda sign: F.array_join(parts, sign)
    line = F.repeat(F.element_at(F.split(F.lit(ALPHABET), ""), (draw(10, len(ALPHABET)) + 1).cast("int")), 24)
    hexes = F.lower(F.hex("digest"))
    uuid = F.concat_ws("-", *[hexes.substr(a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    number = F.translate(F.conv(hexes.substr(1, 15), 16, 10), "-", "")
    dated = F.concat(F.date_add(F.lit("1990-01-01").cast("date"), draw(11, 12000)).cast("string"), F.lit("-"), join("-"))
    ordinaries = {
        "ruled line": line, "camel case": camel, "camel case with a small start": F.concat(F.lower(camel.substr(1, 1)), camel.substr(2, 200)), "under score": join("_"), "hyphen": join("-"),
        "upper case": F.upper(join("_")), "path": join("/"), "words run together": join(""), "with a number": F.concat(join("_"), draw(12, 100).cast("string")), "uuid": uuid, "number": number,
        "dated": dated, "version": F.concat(join("-"), F.lit("-v"), draw(13, 10).cast("string")),
    }

    def made(kinds: dict[str, Column], label: int, length: Column) -> DataFrame:
        pick = (F.col("id") % len(kinds)).cast("int")
        text = F.element_at(F.array(*kinds.values()), pick + 1).substr(F.lit(1), length)
        return ids.select(text.alias("text"), F.lit(label).alias("label"), F.element_at(F.array(*[F.lit(k) for k in kinds]), pick + 1).alias("kind"), draw(14, 4).alias("part"))

    return made(randoms, 1, F.lit(16) + draw(15, 29)).unionByName(made(ordinaries, 0, F.lit(200)))


def kind_of(code: int) -> int:
    """Lower case, upper case, digits, each other sign; 0 is beyond the alphabet."""
    return 0 if code == 0 else 1 if code <= 26 else 2 if code <= 52 else 3 if code <= 62 else code


def codes(token: Column) -> Column:
    """Places of the characters in the alphabet, from 1; 0 for others."""
    return F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))


def train(samples: DataFrame, bigram: float = 0.7) -> list[float]:
    """Log-likelihood ratios of one character after another, row by row: random strings against ordinary identifiers.

    Each model is a mixture of bigram frequencies, with the share `bigram`, and
    of kinds of characters after each other, equal within a kind; so an unseen
    pair of letters counts about as much for both. Only counts of the bounded
    number of pairs reach the driver. Null texts and labels are skipped.
    """
    size = len(ALPHABET) + 1
    coded = samples.where("text is not null and label is not null").select(F.col("label").cast("int").alias("label"), codes(F.col("text")).alias("c"))
    pairs = coded.where(F.size("c") > 1).select("label", F.explode(F.arrays_zip(F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b"))).alias("p"))
    counts = {0: {}, 1: {}}
    for r in pairs.groupBy("label", "p.a", "p.b").count().collect():
        counts[r.label][r.a, r.b] = r["count"]
    members: dict[int, int] = {}
    for c in range(size):
        members[kind_of(c)] = members.get(kind_of(c), 0) + 1
    logs = {}
    for label, seen in counts.items():
        after, kinds, kinds_after = [0] * size, {}, {}
        for (a, b), n in seen.items():
            after[a] += n
            pair = kind_of(a), kind_of(b)
            kinds[pair] = kinds.get(pair, 0) + n
            kinds_after[pair[0]] = kinds_after.get(pair[0], 0) + n
        for a in range(size):
            for b in range(size):
                x, y = kind_of(a), kind_of(b)
                coarse = (kinds.get((x, y), 0) + 1) / (kinds_after.get(x, 0) + len(members)) / members[y]
                fine = seen.get((a, b), 0) / after[a] if after[a] else coarse
                logs[label, a, b] = math.log(bigram * fine + (1 - bigram) * coarse)
    return [logs[1, a, b] - logs[0, a, b] for a in range(size) for b in range(size)]


def ratio(token: Column, model: list[float]) -> Column:
    """The token's log-likelihood ratio; above 0 speaks for a random string."""
    values = F.from_json(F.lit(json.dumps([round(x, 4) for x in model])), "array<double>")
    size = len(ALPHABET) + 1
    c = codes(token)
    return F.aggregate(
        c,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, x: F.struct(x.alias("last"), (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(values, acc["last"] * size + x + 1))).alias("sum")),
    )["sum"]


def threshold(samples: DataFrame, model: list[float], false_alarms: float = 0.001) -> float:
    """The least ratio that at most that share of the samples of label 0 of SHORTEST characters or more reaches; 0 without such samples."""
    scored = samples.where(F.col("label") == 0).where(F.char_length("text") >= SHORTEST).select(ratio(F.col("text"), model).alias("r"))
    found = scored.agg(F.percentile_approx("r", 1 - false_alarms, 100_000)).first()[0]
    return max(0.0, math.nextafter(found, math.inf)) if found is not None else 0.0


def _spans(place: int, kind: str, model: list[float], least_ratio: float) -> Column:
    """A kind's spans from its columns of matches."""
    found = F.col(f"_{kind}_found")
    width = F.col("_values") if kind == "assign" else found
    zipped = F.arrays_zip(F.col(f"_{kind}_starts").alias("start"), found.alias("found"), width.alias("width"))
    if kind == "random":
        wanted = F.filter(zipped, lambda x: ratio(x["found"], model) >= least_ratio)
    else:
        wanted = F.filter(zipped, lambda x: F.char_length(x["width"]) >= LEAST[kind])
    made = F.transform(
        wanted,
        lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("place"), (x["start"] + F.char_length(x["found"])).alias("end"), F.lit(kind).alias("kind")),
    )
    return F.when(F.size(found) > 0, made).otherwise(F.array().cast(SPANS)).cast(SPANS)


SPANS = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"


def scan(docs: DataFrame, model: list[float], text: str = "text", out: str = "secrets", least_ratio: float = 12.0) -> DataFrame:
    """Adds `out`: spans of code points (start, place of the kind, end exclusive, kind), in order.

    Kinds are those of PATTERNS and "random": tokens of SHORTEST characters or
    more that touch no other span and whose log-likelihood ratio is at least
    `least_ratio`. Whole texts, row by row without a shuffle: null and empty
    texts have no span, repeated rows stay, an empty table stays empty, a column
    already named `out` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    rows = docs.select(F.struct(*map(column, kept)).alias("row") if kept else F.lit(0).alias("row"), column(text).alias("text"))
    t = F.col("text")
    none = F.array().cast("array<string>")
    patterns = PATTERNS | {"random": TOKEN}
    for kind, pattern in patterns.items():
        may = t.rlike(MAY.get(kind, pattern))
        rows = rows.withColumn(f"_{kind}_found", F.when(may, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none))
        rows = rows.withColumn(f"_{kind}_between", F.when(may, F.split(t, pattern, -1)).otherwise(none))
    rows = rows.withColumn("_values", F.when(F.size("_assign_found") > 0, F.regexp_extract_all(t, F.lit(PATTERNS["assign"]), F.lit(1))).otherwise(none))
    for kind in patterns:
        found, between = F.col(f"_{kind}_found"), F.col(f"_{kind}_between")
        rows = rows.withColumn(f"_{kind}_steps", F.when(F.size(found) > 0, steps(found, between)))
        rows = rows.withColumn(f"_{kind}_starts", F.when(F.size(found) > 0, running(F.col(f"_{kind}_steps"))))
    spans = {kind: _spans(place, kind, model, least_ratio) for place, kind in enumerate(patterns)}
    rows = rows.withColumn("_base", F.concat(*[spans[k] for k in PATTERNS])).withColumn("_random", spans["random"])
    free = F.filter("_random", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    rows = rows.select("row", F.sort_array(F.concat("_base", free)).alias("spans"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("spans").alias(out))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with models and threshold fitted to the default samples."""
    docs, samples = table(spark, sf_dir, "documents").select("doc_id", "text"), default_samples(spark)
    model = train(samples.where("part < 2"))
    found = scan(docs, model, least_ratio=threshold(samples.where("part = 2"), model))
    base = F.filter("secrets", lambda x: x["kind"] != "random")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in PATTERNS],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("secrets")).alias("spans"),
        count("random").alias("n_random"),
    )
