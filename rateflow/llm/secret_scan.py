"""Secret scans: a random forest that tells credentials from look-alikes.

Candidates are long runs with a digit and values that are assigned, in quotes or
not. Each gets features of its length, of the transitions between kinds of characters, of
how much of it dictionary words cover, of paths, and of the words beside it. A
forest trained on labelled findings decides. Everything is DataFrame functions.
"""

from __future__ import annotations

import base64
import hashlib
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import BROADCAST_IDS, saved

#: Bound of the labelled findings that the forest is trained on.
TRAINING_ROWS = 20000
TREES, DEPTH = 60, 9
#: Values for each kind of made-up finding.
MADE_FINDINGS = 12
#: Findings labelled by hand, a line each.
HAND_LABELLED = Path(__file__).with_name("labelled_findings.txt")
_BEFORE, _AFTER = 64, 48
_OPEN, _CLOSE = "\u0001", "\u0002"
_FINDING = "label INT, candidate STRING, before STRING, after STRING"

# Words beside candidates.
CREDENTIAL_WORDS = (
    r"(?i)(token|secret|passw|pwd|api.?key|access.?key|auth(?!ors?\b)|credential|private)"
)
DIGEST_WORDS = r"(?i)(commit|sha-?\d|md5|checksum|digest|etag|revision|uuid|guid|fingerprint)"
PLACEHOLDER_WORDS = (
    r"(?i)((?<![a-z0-9])(example|sample|dummy|placeholder|changeme\d*|your|redacted)(?![a-z0-9])|xxxx|<)"
)
#: What makes of a credential's name that of something else.
OTHER_NAME = (
    r"(?i)[_.-](id|name|type|kind|file|path|url|uri|host|label|source|count|length|size|limit"
    r"|version|hash|hint|field|column|group|scope|expiry|ttl)[\"']?[ \t]*(:=|=>|[:=])[ \t]*[\"']?$"
)
NUMBER_WORDS = r"(?i)(phone|tel|fax|card|iban|isbn|account|invoice|order|id|no\.?|number)\W*$"

# What a candidate is. Behind each look for a name stands a cheaper
# one for its sign, and loops are over classes, so that long values need no stack.
_SIGN = r"(?::=|=>|[:=])[ \t]{0,4}"
_NAMED = (
    rf"(?<=[:=>][ \t]{{0,4}})(?<=[A-Za-z_\"')\]][ \t]{{0,4}}{_SIGN}|[0-9](?:=|[ \t]{{0,4}}[:=][ \t]{{1,4}}))"
)
_CREDENTIAL_NAMED = rf"(?<={CREDENTIAL_WORDS}[A-Za-z0-9_.-]{{0,24}}[\"']?[ \t]{{0,4}}{_SIGN})"
#: To white space; a quote or separator inside counts, one that ends a field does not.
_PLAIN = r"[^\s\"',;&\u0001\u0002]"
_INSIDE = r"(?:(?<![,{\[(:=])[\"'](?=[^\s,:;)}\]\"'])|[,;&](?!\"|[\w.-]++[\"']?[:=]))"
_UNQUOTED = rf"(?!//){_PLAIN}++(?:{_INSIDE}{_PLAIN}*+)*+"
_RUN = "[A-Za-z0-9+/_-]"
CANDIDATE = (
    r"((?<=[:=] ?[\"'])[^\"'\s\u0001\u0002]{8,}+"
    rf"|{_NAMED}(?=(?:{_PLAIN}|{_INSIDE}){{6}})"
    rf"(?:(?=(?:{_PLAIN}|{_INSIDE}){{8}})|{_CREDENTIAL_NAMED}){_UNQUOTED}"
    rf"|(?<!{_RUN})(?=[A-Za-z+/_-]*+[0-9])"
    rf"(?:{_RUN}{{16,}}+(?!=[^=\s])={{0,2}}+|{_RUN}{{15}}=(?![^=\s])=?+|{_RUN}{{14}}==(?![^=\s])))"
)

# Forms that their issuers give to credentials.
ISSUED_FORMS = (
    r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{10,})"
)

# Values that stand for others, and plain words.
REFERENCE = r"^[$%]?[({<]|^\$\w+$|^%\w+%$|[A-Za-z0-9_][(\[]"
PLAIN_WORD = r"^[A-Za-z]?[a-z]+[.,;:!?)\]}]*$"

# The dictionary for coverage.
DICTIONARY = (
    "about access account address admin after agent alpha also application archive array"
    " author backup base before beta between block book branch bucket build cache call"
    " center change channel check class client cloud code column commit common company"
    " config connect content control copy count country create current data date debug"
    " default delete demo deploy description dev device digest document domain down"
    " draft email engine entry error event example export file filter final first folder"
    " form from function global group handler hash header hello home host html http image"
    " import index info input install internal issue item java key label language last"
    " layer level library license line link list local location login machine main manager"
    " master memory message method model module month name network node note number object"
    " option order output package page param parent part password path pattern platform"
    " point policy port post prefix print process product profile program project public"
    " python query queue record region release remote report request response result role"
    " root route sample schema script search secret section secure select server service"
    " session setting shared source space stack stage state static status storage store"
    " stream string style support system table target task team temp template test text"
    " that theme this thread time title token tool topic total track type update upload"
    " user value version video view water window with word work world year your"
).split()


def candidates(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_md5, nth, candidate, before, after)`` of every candidate in a text.

    Texts are marked where candidates are and cut there, so that all of a text's
    candidates come with their surroundings in one pass: at most 64 code points
    before and 48 after, none of them of another candidate. ``nth`` counts from 1.
    Null and empty texts have none; repeated rows have theirs each.
    """
    plain = F.translate(F.coalesce("text", F.lit("")), _OPEN + _CLOSE, "  ")
    marked = F.regexp_replace(plain, CANDIDATE, f"{_OPEN}$1{_CLOSE}")
    cut = docs.select(
        "doc_id", F.md5("text").alias("text_md5"), F.split(marked, _OPEN).alias("cuts")
    ).where(F.size("cuts") > 1)

    def one(at: Column) -> Column:
        left, own = F.element_at("cuts", at), F.element_at("cuts", at + 1)
        tail = F.substring_index(left, _CLOSE, -1)
        after = F.substring_index(own, _CLOSE, -1)
        return F.struct(
            at.alias("nth"),
            F.substring_index(own, _CLOSE, 1).alias("candidate"),
            F.right(tail, F.lit(_BEFORE)).alias("before"),
            F.left(after, F.lit(_AFTER)).alias("after"),
        )

    places = F.sequence(F.lit(1), F.size("cuts") - 1)
    return cut.select(
        "doc_id", "text_md5", F.explode(F.transform(places, one)).alias("found")
    ).select("doc_id", "text_md5", "found.*")


def _features() -> dict[str, Column]:
    value, before, after = F.col("candidate"), F.col("before"), F.col("after")
    length = F.length(value).cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    def flag(text: Column, pattern: str) -> Column:
        return text.rlike(pattern).cast("double")

    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    uncovered = F.length(F.regexp_replace(F.lower(value), f"({words})", ""))
    letters = count("[A-Za-z]")
    near = F.concat(F.right(before, F.lit(40)), F.lit(" "), F.left(after, F.lit(16)))
    return {
        "length": F.least(length, F.lit(400.0)),
        "digits": count("[0-9]") / length,
        "upper": count("[A-Z]") / length,
        "lower": count("[a-z]") / length,
        "signs": count("[^A-Za-z0-9]") / length,
        "hex_only": flag(value, "^[0-9a-fA-F]+$"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / length,
        "letter_digit": (count("[A-Za-z](?=[0-9])") + count("[0-9](?=[A-Za-z])")) / length,
        "case_change": (count("[a-z](?=[A-Z])") + count("[A-Z](?=[a-z])")) / length,
        "vowel_change": (
            count("(?i)[aeiou](?=[bcdfghjklmnpqrstvwxyz])")
            + count("(?i)[bcdfghjklmnpqrstvwxyz](?=[aeiou])")
        )
        / F.greatest(letters, F.lit(1.0)),
        "consonant_runs": count("(?i)[bcdfghjklmnpqrstvwxyz]{4,}"),
        "repeats": count(r"(.)(?=\1)") / length,
        "covered": F.lit(1.0) - uncovered / length,
        "foreign_letters": F.regexp_count(
            F.regexp_replace(F.lower(value), f"({words})", " "), F.lit("[a-z]")
        ).cast("double"),
        "issued": flag(value, ISSUED_FORMS),
        "word_number": flag(value, r"^[A-Za-z]+[-_ ]?v?[0-9]+$"),
        "reference": flag(value, REFERENCE),
        "digits_only": flag(value, r"^[0-9+=/_.:-]+$"),
        "other_name": flag(before, OTHER_NAME),
        "slashes": count("/") / length,
        "in_path": flag(before, r"([/\\.]|://\S*)$"),
        "path_after": flag(after, r"^[/\\.]\w"),
        "assigned": flag(before, r"[:=]\s*[\"']?$"),
        "quoted": flag(before, r"[\"']$") * flag(after, r"^[\"']"),
        "credential_word": flag(near, CREDENTIAL_WORDS),
        "credential_name": flag(before, CREDENTIAL_WORDS + r"[\w.-]*[\"']?\s*(:=|=>|[:=(])\s*[\"']?$"),
        "digest_word": flag(near, DIGEST_WORDS),
        "placeholder_word": flag(F.concat(near, F.lit(" "), value), PLACEHOLDER_WORDS),
        "number_word": flag(before, NUMBER_WORDS),
    }


def labelled_findings(found: DataFrame) -> DataFrame:
    """Findings with a ``label`` by rule, where none labelled by people are at hand;
    others are left out. ``find_secrets`` does not use these.

    1: an issuer's form, or a mixed value assigned to a credential's name; without
    quotes it must not be a call or a reference. 0: a placeholder, a digest that is
    called one, plain digits, a run inside a path, or a plain word assigned to
    another name; those that are no more than digits count whatever is beside.
    """
    return found.withColumn("label", _rule_label()).where(F.col("label").isNotNull())


def _rule_label() -> Column:
    value, before = F.col("candidate"), F.col("before")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    name = CREDENTIAL_WORDS + r"[\w.-]*[\"']?\s*(:=|=>|[:=])\s*"
    named = before.rlike(name + r"[\"']$") | (before.rlike(name + "$") & ~value.rlike(REFERENCE))
    word = value.rlike(PLAIN_WORD) & ~before.rlike(name + r"[\"']?$")
    placeholder = F.concat(before, value).rlike(PLACEHOLDER_WORDS)
    return (
        F.when(value.rlike(r"^[0-9+=/_-]*[.,;:!?)\]}]*$") | placeholder, 0)
        .when(value.rlike(ISSUED_FORMS) | (named & mixed), 1)
        .when(before.rlike(DIGEST_WORDS) | before.rlike(r"[/\\]$") | word, 0)
    )


def hand_labelled(spark: SparkSession) -> DataFrame:
    """The findings that were labelled by hand."""
    rows = []
    for line in HAND_LABELLED.read_text(encoding="utf-8").splitlines():
        if line.startswith("#"):
            continue
        label, text = line.split("\t", 1)
        before, rest = text.split("<<", 1)
        value, after = rest.rsplit(">>", 1)
        rows.append((int(label), value, before[-_BEFORE:], after[:_AFTER]))
    return spark.createDataFrame(rows, _FINDING)


def made_findings(spark: SparkSession) -> DataFrame:
    """Labelled findings made by rule, always the same: the kinds of values that
    many credentials, digests and numbers have. Values are digests."""
    rows = []
    for i in range(MADE_FINDINGS):
        digest = hashlib.sha512(b"%d" % i).digest()
        mixed = base64.b64encode(digest).decode().translate(str.maketrans("+/=", "xYz"))
        hexed, digits = digest.hex(), str(int.from_bytes(digest, "big"))
        name = ("token", "secret", "api_key", "password", "access_key", "auth")[i % 6]
        other = ("title", "note", "status", "path", "name", "version")[i % 6]
        words = [DICTIONARY[b % len(DICTIONARY)] for b in digest[:3]]
        size = 8 + i % 33
        rows += [
            (1, mixed[:size] + "7a", f'config {name} = "', '" end'),
            (1, mixed[:size] + "7a", f"export {name.upper()}=", " end"),
            (1, mixed[: size // 4 + 6] + "!4b", f"{name}: ", ""),
            (1, mixed[: 24 + size] + "7a", f"{name} ", " end"),
            (1, mixed[: 24 + size] + "7a", "Authorization: Bearer ", ""),
            (1, hexed[:40], f'{name} = "', '"'),
            (1, "".join(words), f"{name.upper()}=", ""),
            (1, "ghp_" + mixed[:36], "", " "),
            (1, "AKIA" + hexed[:16].upper(), f"{name} is ", " end"),
            (0, hexed[: (32, 40, 64)[i % 3]], ("see commit ", "md5 ", "sha256 ")[i % 3], " for that"),
            (0, hexed[:40], "at http://host/", "/page there"),
            (0, digits[:16], "card ", " was used"),
            (0, digits[: 8 + size], f"{other}: ", ""),
            (0, words[0] + "-" + words[1] + str(2000 + i), f"{other}: ", " and"),
            (0, words[0] + words[1] + ".", f"{other}: ", " the"),
            (0, "your_" + name + "_here1", f"{name} = ", ""),
            (0, "get_" + name + "(" + words[0] + ")", f"{name} = ", ""),
            (0, "/".join(words) + "/v2", f"{other}=", " "),
        ]
    return spark.createDataFrame(rows, _FINDING)


def train(
    spark: SparkSession, findings: DataFrame, max_rows: int = TRAINING_ROWS
) -> PipelineModel | None:
    """The forest of at most ``max_rows`` different labelled findings.

    ``findings`` has the columns of ``candidates`` and ``label``; findings alike
    in value and surroundings count once, and classes weigh alike. The choice is
    by hash, and the trees are grown from one small written table, so a rerun
    grows the same. None where the findings do not hold both labels.
    """
    features = _features()
    distinct = findings.groupBy("candidate", "before", "after").agg(F.max("label").alias("label"))
    chosen = distinct.orderBy(
        F.xxhash64("candidate", "before", "after"), "candidate", "before", "after"
    ).limit(max_rows)
    sample = saved(
        spark,
        chosen.select(F.col("label").cast("double").alias("label"), *_named(features))
        .repartition(1)
        .sortWithinPartitions("label", *features),
        "findings",
    )
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    weight = F.when(F.col("label") == 1, 0.5 / sizes[1.0]).otherwise(0.5 / sizes[0.0])
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=17, weightCol="weight", featureSubsetStrategy="sqrt"
    )
    weighted = sample.withColumn("weight", weight * sum(sizes.values()))
    return PipelineModel([assembler, forest.fit(assembler.transform(weighted))])


def _named(features: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in features.items()]


def score(found: DataFrame, model: PipelineModel | None, threshold: float = 0.5) -> DataFrame:
    """The candidates with ``probability`` and ``is_secret``.

    Without a model each candidate's probability is 0.
    """
    if model is None:
        scored = found.withColumn("probability", F.lit(0.0))
    else:
        scored = model.transform(found.select("*", *_named(_features()))).select(
            *found.columns, vector_to_array("probability")[1].alias("probability")
        )
    return scored.withColumn("is_secret", F.col("probability") >= threshold)


def find_secrets(
    spark: SparkSession,
    docs: DataFrame,
    threshold: float = 0.5,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """Candidates of the documents, each decided by the forest alone.

    It is trained on ``labelled (label, candidate, before, after)``: by default
    those labelled by hand and the made ones, so what it learns does not depend
    on the documents. The candidates are written once and scored from there.
    Columns as ``candidates`` and ``score`` give them; an empty table has none.
    """
    found = saved(spark, candidates(docs), "candidates")
    if labelled is None:
        labelled = hand_labelled(spark).union(made_findings(spark))
    return score(found, train(spark, labelled), threshold)


def redact(
    spark: SparkSession, docs: DataFrame, findings: DataFrame, mask: str = "<SECRET>"
) -> DataFrame:
    """The documents with each secret replaced by ``mask``, ``n_chars`` adjusted.

    All columns stay. Each text is freed of its own secrets, by ``text_md5``; findings
    without that column go by doc_id (null is one too), and rows that share one are
    freed of the secrets of all of them.
    """
    by_text = "text_md5" in findings.columns
    key = "text_md5" if by_text else "doc_id"
    secrets = saved(
        spark,
        findings.where("is_secret")
        .groupBy(F.col(key).alias("of"))
        .agg(F.collect_set("candidate").alias("found"))
        .select(F.struct("of", "found").alias("secrets")),
        "secrets",
    )
    size = secrets.agg(
        F.sum(F.length(F.array_join("secrets.found", "")) + 16 * F.size("secrets.found") + 64)
    ).first()[0]
    if (size or 0) <= 8 * BROADCAST_IDS:
        secrets = F.broadcast(secrets)
    left, right = docs.alias("left"), secrets.alias("right")
    if by_text:
        same = F.md5("left.text") == F.col("right.secrets.of")
    else:
        same = F.col("left.doc_id").eqNullSafe(F.col("right.secrets.of"))
    joined = left.join(right, same, "left")
    longest_first = F.array_sort(
        F.col("right.secrets.found"),
        lambda a, b: F.length(b) - F.length(a),
    )
    cleaned = F.coalesce(
        F.aggregate(longest_first, F.col("left.text"), lambda t, s: F.replace(t, s, F.lit(mask))),
        F.col("left.text"),
    )
    replaced = {"text": cleaned}
    if "n_chars" in docs.columns:
        changed = F.col("right.secrets").isNotNull() & F.col("left.text").isNotNull()
        replaced["n_chars"] = F.when(changed, F.length(cleaned).cast("long")).otherwise(
            F.col("left.n_chars")
        )
    return joined.select(
        *(replaced.get(c, F.col(f"left.`{c}`")).alias(c) for c in docs.columns)
    )
