"""Secrets in texts: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, held_out, sample_by_id, table

#: Documents (about so many) whose words surround the labelled findings.
SAMPLE_ROWS = 600
#: A word of at least so many documents is in the dictionary.
DICTIONARY_DOCS = 5
BEFORE, AFTER = 48, 16
# Words beside which a value is a credential, and words beside which it is not.
CREDENTIAL = r"token|secret|passwor[dt]|passwd|passphrase|pwd|api_?key|apikey|access_?key|auth|bearer|credential|private_?key"
HARMLESS = r"commit|sha1|sha256|md5|checksum|digest|etag|revision|version|isbn|invoice|order|phone|build|blob|tree"
#: What stands in front of a credential's value: its name, a colon or equals sign, perhaps a scheme.
ASSIGNED = rf"(?i:[A-Za-z0-9_.\-]*(?:{CREDENTIAL})[A-Za-z0-9_.\-]{{0,16}}[\"']?\s{{0,3}}(?::=|=>|[:=])\s{{0,3}}(?:(?:bearer|basic)\s+)?)"
#: ... or the scheme and user of a url.
USER = r"(?<![A-Za-z0-9+.\-])[A-Za-z][A-Za-z0-9+.\-]*://[^\s/:@]*:"
#: A value beside a credential's name: in quotes (there with spaces), or up to a space or closing mark.
BESIDE = r"\"[^\"\n]{6,}\"|'[^'\n]{6,}'|[^\s\"'`,;<>(){}\[\]]{6,}"
#: A lone value: a maximal run of token characters with a digit among them, 8 at least.
LONE = r"(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z_+/.\-]*+[0-9])[A-Za-z0-9_+/.\-]{7,}[A-Za-z0-9_+/]={0,2}"
CANDIDATE = rf"(?<![A-Za-z0-9_.\-]){ASSIGNED}(?:{BESIDE})|{USER}[^\s/@]{{3,}}(?=@)|{LONE}"
#: What of a match is in front of the value itself.
LEAD = rf"^(?:{ASSIGNED}[\"']?|{USER})"
FEATURES = ["length", "transitions", "digits", "uppers", "hex", "distinct", "dictionary", "slashes", "dots", "spaces", "credential", "harmless", "assigned", "quoted", "in_url"]


def running(sizes: str, block: int = 256) -> Column:
    """For each element of an array column of ints, the sum of those before it. The sums gather in
    blocks, so that a long array takes about half a block's copying for each element."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("total"), F.array().cast("array<array<bigint>>").alias("done"), F.array().cast("array<bigint>").alias("open"))

    def step(acc, size):
        full = F.size(acc["open"]) >= block
        done = F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])
        open_ = F.array_append(F.when(full, F.array().cast("array<bigint>")).otherwise(acc["open"]), acc["total"])
        return F.struct((acc["total"] + size).alias("total"), done.alias("done"), open_.alias("open"))

    return F.aggregate(sizes, start, step, lambda acc: F.flatten(F.array_append(acc["done"], acc["open"])))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, candidate, start, before, after): every candidate at each of its places (start counts
    code points from 1), with the text around it.

    Candidates are runs of 8 token characters or more with a digit; whatever is assigned to a
    credential's name, digits or not, 6 characters or more, in quotes with its spaces; and the password
    of `scheme://user:password@`. Texts are cut at the matches, so the places follow from the lengths
    of what is between; a row needs no other row.
    """
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").rlike(rf"[0-9]|(?i:{CREDENTIAL})|://"))
    cut = some.select("doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"), F.split("text", CANDIDATE, -1).alias("gaps"))
    # What is kept of each match's surroundings is short, so a long text is not copied for each of them.
    cut = cut.select("doc_id", "hits", F.transform("gaps", F.char_length).alias("between"), F.transform("gaps", lambda g: F.right(g, F.lit(BEFORE))).alias("tails"), F.transform("gaps", lambda g: F.left(g, F.lit(AFTER))).alias("heads"))
    cut = cut.withColumn("sizes", F.zip_with("hits", "between", lambda h, b: F.coalesce(F.char_length(h), F.lit(0)) + b))
    cut = cut.withColumn("places", running("sizes"))
    n = F.size("hits")
    ahead = F.concat(F.array(F.lit("")), F.slice("hits", F.lit(1), F.greatest(n - 1, F.lit(0))))
    behind = F.concat(F.slice("hits", F.lit(2), n), F.array(F.lit("")))
    zipped = F.arrays_zip(
        F.col("hits").alias("hit"), F.slice("places", F.lit(1), n).alias("place"), F.slice("between", F.lit(1), n).alias("gap"),
        F.slice("tails", F.lit(1), n).alias("tail"), F.slice("heads", F.lit(2), n).alias("head"), ahead.alias("last"), behind.alias("next"),
    )
    found = cut.select("doc_id", F.explode(zipped).alias("c")).select("doc_id", "c.*").where("hit is not null")
    found = found.withColumn("lead", F.regexp_extract("hit", LEAD, 0))
    body = F.substr("hit", F.char_length("lead") + 1)
    # A value in quotes ends before the closing one; one without ends before a full stop.
    inner = F.when(F.col("lead").rlike("[\"']$"), F.regexp_replace(body, "[\"']$", "")).otherwise(F.regexp_replace(body, r"[.!?:]+$", ""))
    rest = lambda v: F.substr("hit", F.char_length("lead") + F.char_length(v) + 1)
    return found.select(
        "doc_id", inner.alias("candidate"), (F.col("place") + F.col("gap") + F.char_length("lead") + 1).cast("bigint").alias("start"),
        F.right(F.concat("last", "tail", "lead"), F.lit(BEFORE)).alias("before"), F.left(F.concat(rest(inner), "head", "next"), F.lit(AFTER)).alias("after"),
    ).where("candidate <> ''")


def dictionary(docs: DataFrame, least: int = DICTIONARY_DOCS, text_col: str = "text") -> DataFrame:
    """(word): words of three letters at least that stand alone in `least` rows or more, counted over
    all rows. The count combines on the map side, so a word of every row is no hot task."""
    words = F.regexp_extract_all(F.lower(text_col), F.lit(r"(?<![\p{L}\p{N}_])\p{L}{3,}+(?![\p{N}_])"), F.lit(0))
    return docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds FEATURES, all doubles, to findings (candidate, before, after). How much of a candidate is
    dictionary words is looked up once for each different candidate, by a join with the words."""
    c, n = F.col("candidate"), F.greatest(F.lit(1), F.char_length("candidate"))
    runs = found.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word"))
    known = runs.join(words, "word").groupBy(F.col("candidate").alias("of")).agg(F.sum(F.char_length("word")).alias("known"))
    found = found.join(known, F.col("candidate") == F.col("of"), "left")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\p{Ll}", "a"), r"\p{Lu}", "A"), "[0-9]", "0")
    share = lambda pattern: (n - F.char_length(F.regexp_replace(c, pattern, ""))) / n
    near = F.lower(F.concat(F.coalesce("before", F.lit("")), F.lit(" ")))
    values = {
        "length": n, "transitions": (F.char_length(F.regexp_replace(classes, r"(.)\1*", "x")) - 1) / n, "digits": share("[0-9]"), "uppers": share("[A-Z]"),
        "hex": c.rlike("^[0-9a-fA-F]+$"), "distinct": F.size(F.array_distinct(F.split(c, ""))) / n, "dictionary": F.col("known") / n,
        "slashes": share("/"), "dots": share(r"[.\-]"), "spaces": share(r"\s"),
        "credential": near.rlike(rf"({CREDENTIAL})[\w.\-]{{0,16}}[\"']?\W{{0,4}}(bearer |basic )?\W?$"), "harmless": near.rlike(rf"({HARMLESS})\W{{0,3}}$"),
        "assigned": near.rlike(r"[=:]\s*[\"']?\s*$"), "quoted": near.rlike("[\"'] $") & F.coalesce("after", F.lit("")).rlike("^[\"']"),
        "in_url": near.rlike(r"://[^\s/:@]*: $") & F.coalesce("after", F.lit("")).startswith("@"),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()}).drop("of", "known")


def labelled_findings(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, candidate, before, after, label): for each of a bounded sample of documents,
    values of known nature set among the document's own words. No table labels findings, so the label
    is what the value is: keys, tokens and passwords where they are given away; digests, numbers,
    dates, paths, names, addresses and plain words where they are not. The texts made go through
    `candidates` like any other."""
    base = sample_by_id(docs.where(F.col(text_col).isNotNull()), rows, id_col).repartition(4)
    word = F.slice(F.filter(F.split(F.regexp_replace(F.lower(text_col), "[^a-z ]", " "), " +"), lambda w: F.char_length(w) > 2), 1, 6)
    spare = F.array(*[F.lit(w) for w in ("item", "data", "file", "page", "text", "name")])
    base = base.select(F.col(id_col).alias("doc_id"), F.concat(word, spare).alias("w"))
    w = lambda k: F.get("w", F.lit(k))
    key = lambda salt: F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary")
    sha1, sha256, md5 = lambda salt: F.sha1(key(salt)), lambda salt: F.sha2(key(salt), 256), lambda salt: F.md5(key(salt))
    b64 = lambda salt, at, size: F.substring(F.regexp_replace(F.base64(F.unhex(F.sha2(key(salt), 512))), "[+/]", "x"), at, size)
    letters = lambda salt, size: F.substring(F.translate(F.sha2(key(salt), 512), "0123456789", "ghjkmpqrtw"), 1, size)
    number = lambda salt, size: F.substring(F.regexp_replace(F.sha2(key(salt), 512), "[^0-9]", ""), 1, size)
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    # kind: (text in front, value, text behind, label)
    made = {
        "token": ('token = "', sha1("a"), '"', 1), "password_md5": ("password: ", md5("d"), "", 1), "secret_b64": ('secret = "', b64("c", 1, 43), '"', 1), "api_key": ("api_key=", sha256("b"), "", 1),
        "live_key": ("key ", join("sk_live_", b64("o", 1, 24)), "", 1), "access_id": ("", join("AKIA", F.upper(F.substring(sha256("p"), 1, 16))), "", 1), "bearer": ("Authorization: Bearer ", b64("q", 1, 30), "", 1),
        "auth": ("auth ", sha1("e"), "", 1), "passwd": ("passwd='", b64("r", 1, 22), "'", 1), "word_password": ("password: ", join(w(1), number("s", 1), w(2), number("t", 2)), "", 1),
        "short_password": ("pwd=", b64("u", 1, 9), "", 1), "url_password": (join(w(0), "://", w(1), ":"), b64("v", 1, 11), join("@", w(2), ".example.com/", w(3)), 1),
        "url_word_password": (join("https://", w(1), ":"), join(w(2), number("s", 3)), join("@", w(0), ".example.org"), 1), "letters": ('password = "', letters("x", 12), '"', 1),
        "letters_bare": ("secret: ", letters("y", 16), "", 1), "passphrase": ('passphrase: "', join(w(1), " ", w(3), " ", w(2), " ", w(4)), '"', 1), "hyphen_phrase": ("password: ", join(w(1), "-", w(3), "-", w(2), "-", w(0)), "", 1),
        "client_secret": ("client_secret: '", b64("z", 1, 32), "'", 1), "long_name": (join(w(1), "_api_key="), b64("A", 1, 20), "", 1), "pushed_token": ("", join("ghp_", b64("B", 1, 36)), "", 1),
        "query_token": (join("https://", w(0), ".example.com/", w(1), "?access_token="), b64("C", 1, 28), "", 1),
        "commit": ("commit ", sha1("a"), "", 0), "sha256": ("sha256: ", sha256("b"), "", 0), "md5": ("md5 = ", md5("f"), "", 0), "etag": ('etag "', sha1("g"), '"', 0), "see": (join("see ", w(1), "-"), sha1("D"), "", 0),
        "card": ("", number("h", 16), "", 0), "order": ("order ", number("i", 19), "", 0), "phone": ("phone: ", number("m", 17), "", 0), "short_phone": ("", join("555-", number("E", 4)), "", 0),
        "address": ("", join(number("F", 2), ".", number("G", 3), ".", number("H", 2), ".", number("J", 3)), "", 0), "day": ("", join("20", number("j", 2), "-01-31"), "", 0),
        "moment": ("", join("20", number("j", 2), "-01-31T12.30.00.000"), "", 0), "path": ("", join(w(0), "/", w(1), "/", w(2), "_01/", w(3), ".txt"), "", 0), "name": ("", join(w(0), "_", w(1), "_", w(2), "_", number("k", 2), "_", w(3)), "", 0),
        "host": ("", join("mail", number("l", 2), ".", w(1), ".", w(2), ".example.com"), "", 0), "static": ('href="', join("/static/", w(1), "/", F.substring(sha256("b"), 1, 12), ".", w(2)), '"', 0),
        "zeros": ("", F.lit("0000000000000000000000"), "", 0), "version": ("version ", join("v1.2.", number("n", 3), "-", w(1), ".", w(3)), "", 0), "counted": ("token ", join(w(1), "0123456789", w(2)), "", 0),
        "said": ("password: ", w(1), join(" ", w(2)), 0), "said_token": ("token: ", F.lit("required"), join(" ", w(2)), 0), "quoted_word": ('"secret": "', w(3), '"', 0), "uuid": ("id ", join(F.substring(md5("K"), 1, 8), "-", F.substring(md5("K"), 9, 4), "-", F.substring(md5("K"), 13, 4)), "", 0),
        "item": (join(w(1), " "), join(w(2), "-", number("L", 3), "-", w(3)), "", 0),
    }
    front, back = join(w(0), " ", w(1), " "), join(" ", w(2), " ", w(3))
    one = lambda kind, before, value, after, y: F.struct(F.lit(kind).alias("kind"), join(front, before).alias("b"), value.alias("v"), join(after, back).alias("a"), F.lit(float(y)).alias("label"))
    texts = base.select("doc_id", F.explode(F.array(*[one(k, b, v, a, y) for k, (b, v, a, y) in made.items()])).alias("f")).select("doc_id", "f.*")
    texts = texts.withColumn("made", F.struct("doc_id", "kind", "label", (F.char_length("b") + 1).alias("at"))).withColumn("text", F.concat("b", "v", "a"))
    got = candidates(texts, "made", "text")
    # The candidate that holds the value; what else the words give is not labelled.
    inside = (F.col("start") <= F.col("doc_id.at")) & (F.col("doc_id.at") < F.col("start") + F.char_length("candidate"))
    return got.where(inside).select("doc_id.doc_id", "doc_id.kind", "candidate", "before", "after", "doc_id.label")


def train(findings: DataFrame, words: DataFrame, trees: int = 40, depth: int = 9) -> RandomForestClassificationModel | None:
    """The forest of labelled findings (candidate, before, after, label of 0 or 1); None without any."""
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(findings, words)).select("features", "label")
    ready = checkpoint(ready)
    if ready.limit(1).count() == 0:
        return None
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=5, featureSubsetStrategy="sqrt").fit(ready)


def scan(docs: DataFrame, model: RandomForestClassificationModel | None, words: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, candidate, start, length, score, is_secret) of every candidate at each of its places in
    whole texts, each judged by its own surroundings.

    Null and empty texts have none. Repeated rows and repeated or null ids are reported each. Without a
    model every candidate is taken for a secret. Other columns are not read, whatever their names. Only
    the candidates are shuffled, to meet the dictionary.
    """
    found = features(checkpoint(candidates(docs, id_col, text_col)), words)
    if model is None:
        found = found.withColumn("score", F.lit(1.0))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        found = model.transform(ready).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return found.select("doc_id", "candidate", "start", F.char_length("candidate").cast("bigint").alias("length"), "score", (F.col("score") >= threshold).alias("is_secret"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its verdict; the candidate itself only as a digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = checkpoint(dictionary(docs))
    model = train(labelled_findings(docs.where(~held_out())), words)
    return scan(docs, model, words).select("doc_id", F.sha2("candidate", 256).alias("candidate_sha256"), "start", "length", "score", "is_secret")
