"""Secrets in texts: candidate strings, and a random forest that drops the false ones.

Candidates are runs of ``SHORTEST`` or more characters as keys and tokens have them, and of any
length and characters but blanks and quotes what a naming word or ``://user:`` assigns. Their
features are length, character classes and the changes between them, how much of the string a
dictionary of the corpus's common words covers, the path (source) and the words before. The
forest learns from labelled findings: those of ``labelled`` or, if none are given, findings
that fixed rules are sure about, either way. It then decides on all findings, also on those
no rule speaks for.

Only column functions and Spark's own forest are used. The dictionary is counted on all
documents, each distinct text once, and its commonest ``DICTIONARY_WORDS`` words are kept. The
forest is fitted on at most ``TRAINING_FINDINGS`` findings of each label (the lowest hashes);
candidates are sought in whole texts of all rows.

Null texts count as empty. If no finding of one of the two labels exists, the sure rules alone
decide. Rows that share id and text are one row's findings each. An empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.spans import located
from balcao.sources.staging import staged

SHORTEST = 16
SURE_LENGTH = 8
DICTIONARY_WORDS = 10_000  # kept after all are counted, about 100 KB
LEAST_TEXTS = 2  # distinct texts that hold a word of the dictionary; what one text holds is not common
LONGEST_WORD = 40
TRAINING_FINDINGS = 5_000
TREES, DEPTH, SEED = 40, 6, 17
KEEP_AT = 0.5
PATHS = 16
MARK = "[SECRET]"

# Signs of equality behind which a value follows assign it, others fill up a code.
_FILLED = r"(?:={1,2}+(?!\\?[\"'`]?[^\s\"'`<>,;)\]}&\\]))?+"
_RUN = r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{%d,}+" % SHORTEST + _FILLED
_NAMES = r"(?i:pass(?:word|wd)?|token|secret|api[_-]?key|access[_-]?key|auth)"
# Java looks back over bounded lengths only.
_ASSIGNS = r"\\{0,1}[\"'`]{0,1}\s{0,16}[=:]\s{0,16}\\{0,1}[\"'`]{0,1}"
_IN_URL = r"://[^\s:/@]{0,128}:"
# A value ends at a blank, quote or tag, before signs that end a clause, and where `&name=` goes on.
_ENDS = r"(?![,;.)\]}]{1,8}(?:[\s\"'`<]|\z))(?![&;,][A-Za-z0-9_.-]{1,40}[=:])(?!</?[A-Za-z])(?!\\[\"'`])"
_VALUE = r"(?:%s[^\s\"'`])++" % _ENDS
_CANDIDATE = "|".join((
    # What stands before is looked at only where something is assigned.
    rf"(?<=[=:\s\"'`])(?<={_ASSIGNS})(?<={_NAMES}{_ASSIGNS}){_VALUE}",
    rf"(?<=:)(?<={_IN_URL})[^\s\"'`<>/]+(?=@)",
    _RUN,
))
_NAMED = rf"{_NAMES}{_ASSIGNS}$|{_IN_URL}$"
_ISSUED = "^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abpr]-[A-Za-z0-9-]{16,})$"
_REFERENCE = r"^(?:\$\{?\w+\}?|\$\(.*|%\w+%|\{\{.*|<.*>?|\*+)$"  # to a value kept elsewhere
_LETTERS = r"(?<![\p{L}\p{N}])[A-Za-z]{3,}+(?![\p{L}\p{N}])"
_ASSIGNED = r"[=:]\s*\\?[\"'`]?$"
_NEIGHBOURS = "(?i)key|token|secret|pass|auth|login|credential"

FEATURES = (
    "length", "lower", "upper", "digit", "other", "changes", "distinct", "hex", "vowels",
    "covered", "path", "assigned", "quoted", "neighbour",
)


def dictionary(docs: DataFrame) -> list[str]:
    """The words of three letters or more that most distinct texts hold.

    Runs of letters only, cut where a capital follows a small letter; runs with digits are no words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(_LETTERS), F.lit(0)))
    words = F.flatten(F.transform(runs, lambda run: F.split(run, "(?<=[a-z])(?=[A-Z])")))
    words = F.array_distinct(F.transform(words, F.lower))
    words = F.filter(words, lambda w: F.length(w).between(3, LONGEST_WORD))
    texts = docs.select(F.xxhash64(text).alias("tag"), words.alias("words")).dropDuplicates(["tag"])
    counted = texts.select(F.explode("words").alias("w")).groupBy("w").count().where(F.col("count") >= LEAST_TEXTS)
    return [r.w for r in counted.orderBy(F.desc("count"), "w").limit(DICTIONARY_WORDS).collect()]


def _any_of(words: list[str]) -> str:
    """A pattern for the longest of ``words`` at a place: their tree, so that many can be tried at once."""
    tree: dict = {}
    for word in words:
        at = tree
        for letter in word:
            at = at.setdefault(letter, {})
        at[""] = {}

    def pattern(at: dict) -> str:
        ways = [letter + pattern(below) for letter, below in sorted(at.items()) if letter]
        if not ways:
            return ""
        joined = ways[0] if len(ways) == 1 and "" not in at else f"(?:{'|'.join(ways)})"
        return joined + "?" if "" in at else joined

    return pattern(tree)


def findings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tag``, ``path``, ``start``, ``end``, ``found``, ``before`` of every candidate.

    ``docs`` has ``doc_id``, ``text`` and ``source``; ``tag`` is a hash of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64(text).alias("tag"),
        F.col("source").cast("string").alias("path"),
        located(text, _CANDIDATE).alias("spans"),
    ).dropDuplicates(["doc_id", "tag"])
    return rows.select("doc_id", "tag", "path", F.explode("spans").alias("s")).select("doc_id", "tag", "path", "s.*")


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Add the columns of ``FEATURES`` (all doubles)."""
    text = F.col("found")
    size = F.length(text)

    def share(kind: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{kind}]", "")) / size

    classes = text
    for kind, sign in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^aA0]", "-")):
        classes = F.regexp_replace(classes, kind, sign)
    covered = F.lit(0.0)
    if words:
        covered = 1 - F.length(F.regexp_replace(F.lower(text), _any_of(words), "")) / size
    columns = {
        "length": size,
        "lower": share("a-z"),
        "upper": share("A-Z"),
        "digit": share("0-9"),
        "other": 1 - share("A-Za-z0-9"),
        "changes": (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / size,
        "distinct": F.size(F.array_distinct(F.split(text, ""))) / size,
        "hex": text.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "vowels": share("aeiouAEIOU"),
        "covered": covered,
        "path_number": F.pmod(F.xxhash64("path"), F.lit(PATHS)),
        "assigned": F.col("before").rlike(_ASSIGNED).cast("double"),
        "quoted": F.col("before").rlike("[\"'`]$").cast("double"),
        "neighbour": F.col("before").rlike(_NEIGHBOURS).cast("double"),
    }
    return found.withColumns({f"f_{k.removesuffix('_number')}": v.cast("double") for k, v in columns.items()})


def rule_labels(found: DataFrame) -> DataFrame:
    """Add ``label``: 1 or 0 where fixed rules are sure, else null. Needs the features."""
    named = F.col("before").rlike(_NAMED) & (F.col("f_covered") < 0.5)
    # Of what is shorter, rules only know values that mix digits with others.
    mixed = (F.length("found") >= SURE_LENGTH) & F.col("found").rlike("[0-9]") & F.col("found").rlike("[^0-9]")
    wanting = F.col("found").rlike(_REFERENCE)
    sure = F.col("found").rlike(_ISSUED) | (named & ((F.length("found") >= SHORTEST) | mixed) & ~wanting)
    wrong = (F.col("f_covered") >= 0.5) | (F.col("f_digit") == 1) | (F.col("f_lower") == 1) | wanting
    return found.withColumn("label", F.when(sure, 1.0).when(wrong, 0.0))


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """Fit on a bounded number of findings of each label; None if a label has none."""
    distinct = labelled.where("label is not null").dropDuplicates(["found", "before", "label"])
    parts = [
        distinct.where(F.col("label") == value)
        .orderBy(F.xxhash64("found", "before"), "found", "before")
        .limit(TRAINING_FINDINGS)
        for value in (1.0, 0.0)
    ]
    # So few rows train as one sorted partition, which makes the forest reproducible.
    columns = ["label", *[f"f_{name}" for name in FEATURES]]
    rows = parts[0].unionByName(parts[1]).select(*columns).repartition(1).sortWithinPartitions(*columns)
    rows = staged(rows, "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32, featuresCol="features", labelCol="label"
    )
    # The training summary of a fitted forest holds the session, which is not serializable once
    # anything has been observed in it; a copy has no summary.
    return forest.fit(_assembled(rows)).copy()


def _assembled(rows: DataFrame) -> DataFrame:
    inputs = [f"f_{name}" for name in FEATURES]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)


def scored_findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates with ``score`` and ``is_secret``.

    ``labelled`` has ``found``, ``before``, ``path`` and ``label`` (1: a secret, 0: not one).
    """
    words = dictionary(docs)
    found = staged(findings(docs), "findings")
    featured = rule_labels(with_features(found, words))
    model = train(featured if labelled is None else with_features(labelled, words))
    if model is None:
        score = F.coalesce("label", F.lit(0.0))
        return featured.withColumn("score", score).withColumn("is_secret", score >= KEEP_AT)
    judged = model.transform(_assembled(featured))
    return judged.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).withColumn(
        "is_secret", F.col("score") >= KEEP_AT
    )


def _per_document(judged: DataFrame) -> DataFrame:
    """``doc_id``, ``tag``, ``n_candidates`` and ``spans``, the secrets in text order."""
    span = F.when(F.col("is_secret"), F.struct("start", "end"))
    return judged.groupBy("doc_id", "tag").agg(
        F.count("*").alias("n_candidates"), F.array_sort(F.collect_list(span)).alias("spans")
    )


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(
        F.col("doc_id").alias("__id"),
        F.col("tag").alias("__found"),
        F.col("n_candidates").alias("__candidates"),
        F.col("spans").alias("__spans"),
    )
    condition = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__tag") == F.col("__found"))
    return rows.join(found, condition, "left")


def secret_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_candidates``, ``n_secrets`` and ``secrets`` (``start:end`` in code points)."""
    docs = docs.select("doc_id", "text", "source")
    found = _per_document(scored_findings(docs))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__tag"))
    spans = F.transform("__spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return _joined(rows, found).select(
        "doc_id",
        F.coalesce("__candidates", F.lit(0)).cast("bigint").alias("n_candidates"),
        F.coalesce(F.size("__spans"), F.lit(0)).cast("bigint").alias("n_secrets"),
        F.coalesce(F.array_join(spans, ","), F.lit("")).alias("secrets"),
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span exchanged for ``MARK``."""

    def add(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(span["end"].alias("at"), F.concat(state["out"], between, F.lit(MARK)).alias("out"))

    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        add,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text``; all rows and columns stay."""
    found = _per_document(scored_findings(docs.select("doc_id", "text", "source"))).where(F.size("spans") > 0)
    rows = docs.withColumn("__tag", F.xxhash64(F.coalesce("text", F.lit(""))))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(
        masked(F.col("text"), F.col("__spans"))
    )
    joined = _joined(rows, found)
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
