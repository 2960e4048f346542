"""Secret scan: candidates judged by a random forest that learns from labelled findings.

A candidate is a private-key block, the user information of a URL, a value of
any length and alphabet that is assigned to a credential's name, or a run of at
least 16 characters of the usual key alphabet that holds a digit, changes often
between cases or is a long run of one case.  Its features are its length, how its characters change class
(transitions and shares of classes), how much of it dictionary words cover, the
path it was found at (the source) and the words next to it.  A forest trained
on labelled findings removes false positives: identifiers, digests, card
numbers and placeholders.

Where no labelled findings are given, they are taken from the scanned documents
themselves, by evidence outside the features' thresholds: known key formats and
assignments to a credential's name are secrets; numbers, identifiers beside
digest words and runs made of dictionary words are not.  Candidates without
such evidence are judged by the forest alone; of the forms that are no plain
run, those with evidence are judged by it, as few corpora hold enough of them.  The forest is fitted on at most
about ``SAMPLE_FINDINGS`` findings of each label, chosen by a hash.

Scale: built-in expressions only.  Texts without a candidate are never taken apart; candidates (not texts) are shuffled, and texts only of
documents that have a candidate, when their secrets are replaced.

Defined cases: a null text has no candidate; repeated rows have the same
findings; a null source counts as an empty path; a table without findings of
both labels is judged by the evidence alone; an empty table gives an empty
result; other columns pass through ``redact``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import let, own_name, written

RUN = (r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}|(?=(?:[A-Z+/_-]*[a-z]+[A-Z]){3})[A-Za-z+/_-]{16,}"
       r"|(?:[a-z]{24,}|[A-Z]{24,})(?![A-Za-z0-9+/_-]))={0,2}")
PEM = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,-]{0,20000}?-----END [A-Z ]{0,20}PRIVATE KEY-----)?"
URL_USER = r"(?<=://)[^\s/:@\"'<>]{1,100}:[^\s/@\"'<>]{1,200}(?=@)"
# Ends of names that credentials are assigned to, and what may stand between name and value.
_NAMES = "(?i:" + "|".join(f"(?<={n})" for n in ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "api-key", "apikey", "access_key",
                                                 "access-key", "accesskey", "secret_key", "secret-key", "secretkey", "private_key", "private-key",
                                                 "privatekey", "auth", "credential", "credentials")) + ")"
_SIGNS = ["=", " =", "= ", " = ", ":", ": ", " : ", ":=", " := ", "=>", " => "]


def _after(quotes: tuple[str, ...]) -> str:
    """A place after a credential's name, a sign and one of ``quotes``; look-behinds of fixed width, as not all engines have others."""
    return "(?:" + "|".join(f"(?<={_NAMES}{close}{sign}{quote})" for close in ("", '"', "'") for sign in _SIGNS for quote in quotes) + ")"


ASSIGNED = (r"(?:(?<=[=:>][\"'])|(?<=[=:>] [\"']))" + _after(('"', "'")) + r"[^\"'\n]{1,1000}(?=[\"'])"
            r"|(?:(?<=[=:>])|(?<=[=:>] ))" + _after(("",)) + r"[^\s\"'<>,;]{0,1000}[^\s\"'<>,;.:=!?)\]}]={0,2}")
CANDIDATE = f"{PEM}|{URL_USER}|{ASSIGNED}|{RUN}"
CONTEXT = 48
MARK = "[SECRET]"
SAMPLE_FINDINGS = 10_000
LEAST_FINDINGS = 20
TREES, DEPTH, SEED = 20, 6, 11
THRESHOLD = 0.5

# Formats of keys that name their issuer.
KEY_FORMATS = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^github_pat_|^sk_live_|^sk-[A-Za-z0-9]{20}|^xox[baprs]-|^AIza[A-Za-z0-9_-]{35}$"
               r"|^-----BEGIN [A-Z ]*PRIVATE KEY-----|^glpat-|^npm_[A-Za-z0-9]{36}$|^eyJ[A-Za-z0-9_-]{16,}")
# Names that credentials are assigned to, and words beside harmless identifiers.
CREDENTIAL_WORDS = r"(password|passwd|pwd|secret|token|api_?-?key|access_?-?key|auth|credential|private_?-?key)"
HARMLESS_WORDS = r"(sha1|sha256|md5|checksum|digest|commit|revision|uuid|guid|etag|isbn|order|invoice|example|sample|dummy|placeholder)"
PLACEHOLDER_PATHS = r"(test|example|sample|mock|fixture|doc|demo)"
# Unquoted values that are words of a sentence or expressions of a program.
NO_VALUE = r"^(?i:none|null|nil|true|false|undefined)$|^[$%{<]|[(\[]|^[*x.]+$"
# Words that placeholders and identifiers are made of.
DICTIONARY = ["access", "admin", "api", "auth", "build", "change", "class", "client", "code", "commit", "config", "data", "demo", "document", "dummy", "example",
              "file", "foo", "hello", "here", "id", "image", "index", "insert", "key", "local", "message", "name", "number", "page", "password", "path",
              "placeholder", "private", "public", "release", "replace", "sample", "secret", "server", "service", "session", "some", "string", "system", "table",
              "test", "text", "the", "this", "title", "token", "update", "user", "value", "version", "with", "world", "your"]
FEATURES = ["length", "transitions", "digits", "uppers", "lowers", "hex", "repeats", "dictionary", "path", "credential", "harmless", "assigned", "format"]


def _found(text: Column) -> Column:
    """Array of struct(place, start, value, before, after) of the candidates of ``text``; empty where there are none."""
    def build(values: Column, gaps: Column) -> Column:
        lengths = F.transform(values, lambda v, i: F.length(v) + F.length(F.get(gaps, i)))
        return F.transform(values, lambda v, i: F.struct(
            i.alias("place"),
            (F.aggregate(F.slice(lengths, 1, i), F.lit(0), lambda a, x: a + x) + F.length(F.get(gaps, i))).cast("long").alias("start"),
            v.alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))

    return let(F.regexp_extract_all(text, F.lit(CANDIDATE), 0), lambda values: let(F.split(text, CANDIDATE), lambda gaps: build(values, gaps)))


def has_candidate(text: Column) -> Column:
    return F.coalesce(text.rlike(CANDIDATE), F.lit(False))


def candidates(docs: DataFrame) -> DataFrame:
    """One row for each candidate in ``docs`` (doc_id, text, source): the columns of ``_found`` and the features."""
    rows = docs.select("doc_id", "source", "text").filter(has_candidate(F.col("text")))
    rows = rows.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.explode(_found(F.col("text"))).alias("c")).select(
        "doc_id", "source", "text_hash", "c.*")
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda pattern: F.length(F.regexp_replace(v, pattern, "")) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "b"), "[+/_=-]+", ".")
    # The word beside the candidate: the name it is assigned to, or the last whole word.
    near = F.lower(F.concat_ws(" ", F.regexp_extract("before", r"([A-Za-z0-9_.-]+[\s\"'=:>]*)$", 1), F.regexp_extract("after", r"^[\s\"']*([A-Za-z0-9_.-]+)", 1)))
    words = "(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))
    flag = lambda c: c.cast("double")
    url = F.col("before").rlike("://$") & v.contains(":")
    return rows.withColumns({
        "length": n, "transitions": (F.length(classes) - 1) / n, "digits": share("[^0-9]"), "uppers": share("[^A-Z]"), "lowers": share("[^a-z]"),
        "hex": flag(v.rlike("^[0-9a-f]+$")), "repeats": 1 - F.size(F.array_distinct(F.split(v, ""))) / n,
        "dictionary": 1 - F.length(F.regexp_replace(v, words, "")) / n,
        "path": flag(F.lower(F.coalesce("source", F.lit(""))).rlike(PLACEHOLDER_PATHS)),
        "credential": flag(near.rlike(CREDENTIAL_WORDS) | url), "harmless": flag(near.rlike(HARMLESS_WORDS)),
        "assigned": flag(F.col("before").rlike(r"([=:]|=>)\s*[\"']?$") | url), "format": flag(v.rlike(KEY_FORMATS))})


def evidence(found: DataFrame) -> DataFrame:
    """``found`` with label 1 (secret), 0 (not) or null (no evidence)."""
    secret = (F.col("format") == 1) | ((F.col("credential") == 1) & (F.col("assigned") == 1))
    # A short number assigned to a credential's name is one; a word after a colon or an expression is not.
    number = (F.col("digits") > 0.9) & ~(secret & (F.col("length") < 13))
    bare = ~F.col("before").rlike("[\"']$") & (F.col("value").rlike(NO_VALUE) | F.col("before").rlike(r":\s*$") & F.col("value").rlike("^[A-Z]?[a-z]+$"))
    harmless = number | (F.col("harmless") == 1) | (F.col("dictionary") > 0.5) | bare
    return found.withColumn("label", F.when(harmless & ~(F.col("format") == 1), 0.0).when(secret, 1.0))


def fit(findings: DataFrame):
    """Forest from ``findings`` (FEATURES, label), or None where a label is missing; at most a sample is used."""
    sizes = {r[0]: r[1] for r in findings.filter("label IS NOT NULL").groupBy("label").count().collect()}
    if min(sizes.get(0.0, 0), sizes.get(1.0, 0)) < LEAST_FINDINGS:
        return None
    place = F.pmod(F.xxhash64("value", "doc_id"), F.lit(1_000_000))
    share = F.when(F.col("label") == 1, min(1.0, SAMPLE_FINDINGS / sizes[1.0])).otherwise(min(1.0, SAMPLE_FINDINGS / sizes[0.0]))
    sample = findings.filter(F.col("label").isNotNull() & (place < share * 1_000_000)).select(*FEATURES, "label")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8)
    # In one order, so that reruns grow the same trees.
    return forest.fit(_vectors(sample).repartition(1).sortWithinPartitions(*FEATURES, "label"))


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows)


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, text_hash, source, place, start, length, value, score, is_secret of every candidate in ``docs``."""
    found = written(evidence(candidates(docs)), "secret-candidates")
    forest = fit(found if findings is None else findings)
    if forest is None:
        judged = found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        judged = forest.transform(_vectors(found)).withColumn("score", vector_to_array("probability")[1])
        judged = judged.withColumn("score", F.when(F.col("value").rlike(f"^{RUN}$"), F.col("score")).otherwise(F.coalesce("label", "score")))
    return judged.select("doc_id", "text_hash", "source", "place", "start", F.length("value").cast("long").alias("n_chars"), "value", "score",
                         (F.col("score") >= THRESHOLD).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame | None = None, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``MARK``; the column ``size``, if there, is the new length in those rows."""
    keys = [own_name(docs, c) for c in ("secret_doc", "secret_text", "secret_path", "secret_places")]
    found = scan(docs.select("doc_id", F.col(text).alias("text"), "source"), findings).filter("is_secret")
    places = found.groupBy("doc_id", "text_hash", "source").agg(F.collect_set("place").alias("places"))
    places = written(places.select(*[F.col(c).alias(k) for c, k in zip(["doc_id", "text_hash", "source", "places"], keys)]), "secret-places")
    touched = has_candidate(F.col(text))
    same = (F.col("doc_id").eqNullSafe(F.col(keys[0])) & (F.xxhash64(F.col(text)) == F.col(keys[1])) & F.col("source").eqNullSafe(F.col(keys[2])))
    rows = docs.filter(touched).join(places, same, "left")

    def rebuilt(values: Column, gaps: Column) -> Column:
        parts = F.transform(gaps, lambda g, i: F.concat(g, F.when(F.array_contains(keys[3], i), F.lit(MARK)).otherwise(F.coalesce(F.get(values, i), F.lit("")))))
        return F.array_join(parts, "")

    new = let(F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), 0), lambda v: let(F.split(F.col(text), CANDIDATE), lambda g: rebuilt(v, g)))
    rows = rows.withColumn(text, F.when(F.col(keys[3]).isNotNull(), new).otherwise(F.col(text)))
    if size is not None and size in docs.columns:
        kind = docs.schema[size].dataType
        rows = rows.withColumn(size, F.when(F.col(keys[3]).isNotNull(), F.length(F.col(text)).cast(kind)).otherwise(F.col(size)))
    return docs.filter(~touched).unionByName(rows.select(*docs.columns))
