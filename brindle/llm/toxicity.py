"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features are column expressions over the whole text; nothing else about a document is an input.  All fitting
uses at most MAX_ROWS labelled rows, picked by a hash of the id, and none of fold 0: a lexicon of word
beginnings that mark toxic texts comes from the folds LEXICON_FOLDS, the trees learn from TREE_FOLD and the
calibration from CALIBRATION_FOLD, so no step is fitted on what an earlier one has seen.  The sample is small enough
to broadcast, and every document is scored.

Defined results: null text counts as empty; empty texts get the score of their features like any other.
Without labelled training rows of both classes, and for the calibration likewise, the score is the share of
label 1 (0 without rows).  Rows repeated in the documents are scored each; a repeated label row counts once,
as its largest value; null labels are left out.  A null id is not held out.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm._common import stored, text_of, words

# Insults, pronouns of the second person, and characters that stand for letters.
LEXICON = """
idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool fools loser losers scum trash garbage
clown clowns worthless pathetic disgusting vile filth filthy pig pigs rat vermin parasite retard retarded imbecile
cretin ugly hate shut bastard bitch crap damn hell asshole ass shit fuck fucking whore slut creep freak jerk
degenerate lowlife subhuman braindead useless hideous repulsive
idiota imbécil estúpido basura asqueroso connard imbécile ordure abruti crétin dummkopf abschaum arschloch
""".split()
SECOND_PERSON = "you your yours yourself u ur tu te toi vous votre du dich dir dein ihr usted ustedes ti".split()
LOOKALIKES = ("0134578@$!", "oieastbasi")

FOLDS = 5
LEXICON_FOLDS, TREE_FOLD, CALIBRATION_FOLD = (1, 2), 3, 4
MAX_ROWS = 50_000
#: Lengths of the learned word beginnings, how many are used per tier, the share of toxic texts that must have one,
#: and how many times as many toxic as other texts a strong and a weak one need.
STEM_LENGTHS, STEMS, SUPPORT, STRONG, WEAK = (3, 4, 5, 6, 8), 100, 0.02, 8, 2
FEATURES = (
    "stems stems_rate weak weak_rate insults insults_rate insults_any plain_only lookalikes_rate aimed aimed_rate capitals caps_words exclaims punctuation length"
).split()


def _any_of(names: list[str]) -> str:
    return rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(names)})(?![\p{{L}}\p{{N}}])"


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def learned_stems(texts: DataFrame) -> tuple[list[str], list[str]]:
    """Strong and weak word beginnings that mark toxic texts, from (text, label); equal texts count once."""
    rows = texts.groupBy(F.lower("text").alias("low")).agg(F.max("label").alias("label"))
    n_toxic = rows.agg(F.sum("label")).first()[0] or 0
    least = max(3.0, SUPPORT * n_toxic)
    parts = F.array_distinct(F.regexp_extract_all("low", F.lit(r"(?<!\p{L})\p{L}{3,8}"), F.lit(0)))
    stems = F.array_distinct(
        F.flatten(F.transform(parts, lambda w: F.array(*[F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in STEM_LENGTHS])))
    )
    counted = rows.select("label", F.explode(stems).alias("stem")).where("stem is not null").groupBy("stem").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")
    )
    frequent = stored(counted.where(F.col("toxic") >= least), "toxicity-stems")
    strong = F.col("other") * STRONG <= F.col("toxic")
    tiers = (strong, ~strong & (F.col("other") * WEAK <= F.col("toxic")))
    return tuple(
        [r.stem for r in frequent.where(tier).orderBy(F.desc("toxic"), F.length("stem"), "stem").limit(STEMS).collect()] for tier in tiers
    )


def _starts_with(stems: list[str]) -> str:
    """A pattern for any of the stems that reads a letter once, however many stems begin with it."""
    tree: dict = {}
    for stem in sorted(stems, key=len):
        node = tree
        for letter in stem:
            if None in node:
                break  # a shorter stem matches already
            node = node.setdefault(letter, {})
        else:
            node[None] = {}

    def written(node: dict) -> str:
        if None in node:
            return ""
        ways = [letter + written(rest) for letter, rest in node.items()]
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return written(tree)


def features(
    documents: DataFrame, stems: tuple[list[str], list[str]], doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, the columns in ``keep``, one double per name in FEATURES); stems are letters only."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), *keep, text_of(text).alias("text")).select(
        "doc_id", *keep, "text", F.lower("text").alias("low"), F.greatest(F.size(words(F.col("text"))), F.lit(1)).cast("double").alias("n")
    )
    count = lambda column, pattern: F.regexp_count(column, F.lit(pattern)).cast("double")
    insult, person = _any_of(LEXICON), _any_of(SECOND_PERSON)
    # Digits and signs inside a word are read as the letters they look like; the rest of the text is not touched.
    disguised = F.regexp_extract_all("low", F.lit(r"(?<!\p{L})\p{L}++[0-9@$!]++\p{L}[\p{L}0-9@$!]*+"), F.lit(0))
    rows = rows.withColumn("disguised", F.translate(F.array_join(disguised, " "), *LOOKALIKES))
    rows = rows.withColumn("plain", count("low", insult)).withColumn("hidden", count("disguised", insult))
    gap = r"(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+){0,3}[^\p{L}\p{N}]+"
    aimed = F.when(
        F.col("plain") > 0, count("low", f"{person}{gap}(?={insult})") + count("low", f"{insult}(?={gap}{person})")
    ).otherwise(0.0)
    rows = rows.withColumn("hits", F.col("plain") + F.col("hidden")).withColumn("aimed", aimed)
    size = F.greatest(F.length("text"), F.lit(1)).cast("double")
    marked = [count("low", rf"(?<!\p{{L}}){_starts_with(tier)}") if tier else F.lit(0.0) for tier in stems]
    rows = rows.withColumn("marked", marked[0]).withColumn("hinted", marked[1])
    values = {
        "stems": F.least(F.col("marked"), F.lit(50.0)),
        "stems_rate": F.col("marked") / F.col("n"),
        "weak": F.least(F.col("hinted"), F.lit(50.0)),
        "weak_rate": F.col("hinted") / F.col("n"),
        "insults": F.least(F.col("hits"), F.lit(50.0)),
        "insults_rate": F.col("hits") / F.col("n"),
        "insults_any": (F.col("hits") > 0).cast("double"),
        "plain_only": F.least(F.col("plain"), F.lit(50.0)),
        "lookalikes_rate": F.size(F.split("disguised", " ")) / F.col("n"),
        "aimed": F.least(F.col("aimed"), F.lit(50.0)),
        "aimed_rate": F.col("aimed") / F.col("n"),
        "capitals": count("text", r"\p{Lu}") / size,
        "caps_words": count("text", r"(?<!\p{L})\p{Lu}{3,}(?!\p{L})") / F.col("n"),
        "exclaims": count("text", "[!?]") / F.col("n"),
        "punctuation": count("text", r"\p{Punct}") / size,
        "length": F.log1p("n"),
    }
    return rows.select("doc_id", *keep, *[values[name].cast("double").alias(name) for name in FEATURES])


def scored(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, the columns in ``keep``, held_out, score, predicted); rows of fold 0 are held out of all fitting."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id")).agg(F.max(label).cast("double").alias("label"))
    known = known.withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0")
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "toxicity-sample")
    small = F.broadcast(sample)  # at most MAX_ROWS rows of an id, a label and a fold
    texts = documents.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    stems = learned_stems(texts.join(small.where(F.col("fold").isin(*LEXICON_FOLDS)), "doc_id").select("text", "label"))
    rows = stored(features(documents, stems, doc_id, text, keep), "toxicity-features")
    training = stored(rows.join(small, "doc_id"), "toxicity-training")
    counts = {r.fold: (r.n, r.ones) for r in training.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    n, ones = (sum(c[i] for c in counts.values()) for i in (0, 1))
    both = lambda c: 0 < c[1] < c[0]
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    if not both((n, ones)):
        score = F.lit(float(ones / n) if n else 0.0)
        return rows.select("doc_id", *keep, held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    # A fold without rows of both classes is replaced by all of them.
    of_trees, of_steps = (
        training.where(F.col("fold") == f) if both(counts.get(f, (0, 0))) else training for f in (TREE_FOLD, CALIBRATION_FOLD)
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(labelCol="label", maxIter=10, maxDepth=4, stepSize=0.3, seed=7).fit(
        assembler.transform(of_trees)
    )

    def margins(table: DataFrame) -> DataFrame:
        out = trees.transform(assembler.transform(table))
        return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("features", "rawPrediction", "probability", "prediction")

    steps = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins(of_steps).select("margin", "label"))
    out = steps.transform(margins(rows)).withColumn("score", F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)))
    return out.select("doc_id", *keep, held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
