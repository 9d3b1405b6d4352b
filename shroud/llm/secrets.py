"""Secret scan with a random forest that removes false positives.

Candidates: in every word between white space, every stretch of 16 or more of A-Z a-z 0-9
``+ / _ -``; ``part`` numbers them within their word.  A signed web token (its parts joined by
dots) is one candidate.  A stretch that is the name before ``=`` or ``:`` is none.  Base64's
closing ``=`` do not count.  Assigned to a name such as password or token (``SHORT``), a value of
6 characters is a candidate too, with any signs but quotes, brackets, comma, ; and &.  What stands around a candidate is kept ``NEAR`` characters far, so
that a long line without blanks costs no more than its length.  Features (DataFrame functions only): length; shares of digits, capitals and vowels;
share of changes between letters, digits and signs and between cases; share of distinct
characters; how much of it the corpus dictionary covers; words of the path; the words around it.
The dictionary is the most frequent words of 3 to 6 letters, counted over all documents.

The forest (Spark's own) is trained on labelled findings: rows of features with ``label`` 0 or 1,
of which a bounded sample of ``SAMPLE`` a label is used, by a seeded hash.  Where no labelled table
exists, ``weak_labels`` labels the clear cases only: 1 if assigned to a name like token, key or
password, sent as a bearer, first line of a private key, or of an issued key's shape; 0 for plain
words, numbers and UUIDs without a name, and for named placeholders.  The rest has no label.  The
forest sees all ``FEATURES``, the path's and the neighbours' too, and scores every candidate, labelled
or not.  So that it does not copy the rule, a clear case is learnt a second time with the context
hidden or turned (``lessons``): a key without its name stays one, a plain word after a name is prose.
It learns from drawn keys of usual forms as well (``drawn``), bare ones and assigned ones, on paths of
the corpus, so that a bare key is found by its looks.

Defined cases: null or empty text has no candidate.  Path null: empty.  Repeated rows repeat their
findings.  If all labelled findings have one label, every candidate gets that label's score.
Extra columns are ignored.  No row: no finding.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

SAMPLE, DICTIONARY, THRESHOLD, SEED = 5000, 200, 0.5, 3
#: ``key`` as a whole word or the last of a name (private_key, encryptionKey), but no author.
NAMES = r"(?i)(token|secret|passw|pwd|api_?key|access_?key|credential|auth(?!or)|(^|[^a-z])key($|[^a-z])|(?-i:[a-z]Key))"
SHORT = r"(?i:token|secret|passw|pwd|api[_-]?key|(?:access|private|encryption|signing)[_-]?key|credential)"
SENT = r"""(?i)(bearer|authorization["']?[:=] ?["']?(basic|token|apikey))$"""
PEM = "PRIVATE KEY-----$"
UUID = "^(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
DUMMIES = r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|test)"
#: Shapes of issued keys (cloud access key, source host token, signed web token).
ISSUED = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|eyJ[0-9A-Za-z_-]{16,})"
STRETCH = r"[0-9A-Za-z+/_-]{16}"
_WEB = r"eyJ[0-9A-Za-z_-]{8,}+(?:\.{1,2}[0-9A-Za-z_-]++){1,4}"
#: A web token, or a stretch up to the next web token (possessive: no recursion on long ones).  Within a
#: stretch a web token's first part is looked for in the next ``HEAD`` characters, so that a text of many
#: beginnings takes time in proportion to its length.
HEAD = 2048
PARTS = rf"({_WEB}|(?:(?!eyJ[0-9A-Za-z_-]{{8,{HEAD}}}+\.{{1,2}}[0-9A-Za-z_-])[0-9A-Za-z+/_-]){{16,}}+)"
#: An identifier: letters with few digits.  And what follows one that is a name: a colon, an equals
#: sign with a value (else it may be base64's).
IDENTIFIER = r"^[_-]*[A-Za-z][A-Za-z_-]*([0-9]{1,2}[A-Za-z_-]*){0,2}$"
NAMES_VALUE = r"""^["']?(:|[:=]{1,2}(["']["']|["']?[0-9A-Za-z+/_.$-]))"""
_ASSIGNED = rf"""{SHORT}[0-9A-Za-z_.-]{{0,20}}["']?"""
_VALUE = r"""(?![$%])[^\s"'`,;&<>(){}\[\]]{6,}+(?![(\[])"""
#: A shorter value: in the word of its name, or at the start of the word after (there no plain word
#: without quotes, which is prose).
SHORT_IN = rf"""(?<={_ASSIGNED}[:=]{{1,2}}["']?){_VALUE}"""
SHORT_AFTER = rf"""(?<=^["'`]{{0,2}})(?!(?<!["'`])[A-Za-z][a-z]*+[.!?:]*+$){_VALUE}"""
NAMED_BEFORE = rf"""{_ASSIGNED} ?[:=]{{1,2}}$"""
NEAR = 64
#: The looks of the candidate itself; then its path and neighbours.
SHAPE = ["length", "digits", "capitals", "vowels", "turns", "case_turns", "distinct_chars", "dictionary"]
FEATURES = [*SHAPE, "path_dummy", "path_depth", "name_near", "assigned", "quoted", "dummy_near"]


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               path_col: str = "source") -> DataFrame:
    """doc_id, word_no, part, candidate, lead and tail (in the word), before (two words), after, path."""
    words = F.split(F.col("text"), r"[\x20\x09-\x0D]+")
    near = lambda i: F.coalesce(F.get("words", F.col("word_no") + i), F.lit(""))
    piece = lambda i: F.coalesce(F.get("pieces", F.col("at") + i), F.lit(""))
    # No word holds a blank: between blanks, every second piece is a candidate.
    mark = lambda short: F.split(F.regexp_replace("word", f"({PARTS[1:-1]}|{short})", " $1 "), " ")
    pieces = F.when(F.col("named"), mark(f"{SHORT_IN}|{SHORT_AFTER}")).otherwise(mark(SHORT_IN))
    named_before = (near(-1).rlike("[:=]$") & F.concat_ws(" ", F.right(near(-2), F.lit(NEAR)),
                                                          F.right(near(-1), F.lit(NEAR))).rlike(NAMED_BEFORE))
    long = (F.length("word") >= 16) & F.col("word").rlike(STRETCH)
    short = F.col("word").rlike("[:=]") & F.col("word").rlike(SHORT_IN)
    c, tail = F.col("candidate"), F.col("tail")
    padded = tail.rlike(r"^=$") & (F.length(c) % 4 == 3) | tail.rlike(r"^==$") & (F.length(c) % 4 == 2)
    named = (tail.rlike(NAMES_VALUE) | tail.rlike("^[:=]+$") & ~padded
             | tail.rlike("""^["']?$""") & F.col("after").rlike("^(:|=)"))
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"))
            .where(F.col("text").rlike(STRETCH) | F.col("text").rlike(rf"""{_ASSIGNED}[\x20\x09-\x0D]*[:=]"""))
            .select("doc_id", "path", words.alias("words"))
            .select("doc_id", "path", "words", F.posexplode("words").alias("word_no", "word"))
            .where((F.length("word") >= 6) & (long | short | named_before))
            .withColumn("named", named_before)
            .select("doc_id", "word_no", "path", F.right(near(-2), F.lit(NEAR)).alias("before2"),
                    F.right(near(-1), F.lit(NEAR)).alias("before1"),
                    F.left(near(1), F.lit(NEAR)).alias("after"), pieces.alias("pieces"))
            # outer: else Spark filters by the size of the pieces first, and cuts every word twice
            .select("*", F.posexplode_outer("pieces").alias("at", "candidate")).where("at % 2 = 1")
            .select("doc_id", "word_no", ((F.col("at") - 1) / 2).cast("long").alias("part"), "path", "candidate",
                    F.right(F.concat(piece(-2), piece(-1)), F.lit(NEAR)).alias("lead"),
                    F.left(F.concat(piece(1), piece(2)), F.lit(NEAR)).alias("tail"),
                    F.concat_ws(" ", "before2", "before1").alias("before"), "after")
            .where(~(named & c.rlike(IDENTIFIER) & ~c.rlike(ISSUED))))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 6 ASCII letters over all documents."""
    w = docs.select(F.explode(F.split(F.lower(text_col), r"[^a-z]+")).alias("w"))
    top = (w.where(F.length("w").between(3, 6)).groupBy("w").agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), "w").limit(size).collect())
    return [r.w for r in top]


def features(found: DataFrame, known: list[str]) -> DataFrame:
    """``found`` with the columns of ``FEATURES``; ``word`` may stand for ``lead`` and ``tail``."""
    if "lead" not in found.columns:
        found = found.withColumns({
            "lead": F.expr("left(word, greatest(instr(word, candidate) - 1, 0))"),
            "tail": F.expr("if(instr(word, candidate) > 0, "
                           "substring(word, instr(word, candidate) + length(candidate)), '')")})
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    covered = (n - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(known, key=lambda w: (-len(w), w))), ""))
               ) / n if known else F.lit(0.0)
    yes = lambda x: x.cast("double")
    lead = F.col("lead")
    here = lead.rlike("[=:]")  # a name in the word itself goes before the words ahead
    name = F.when(here, F.regexp_extract(lead, r"""([^"'=:,;&?{}\[\]]*)["']?[=:]+[^=:]*$""", 1)).otherwise(F.col("before"))
    sent = F.col("before").rlike(SENT) & ~here
    around = F.concat_ws(" ", "before", F.concat("lead", "candidate", "tail"), "after")
    return found.withColumns({
        "length": n.cast("double"), "digits": share("[0-9]"), "capitals": share("[A-Z]"),
        "vowels": share("(?i)[aeiou]"),
        "turns": share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]|(?<=[0-9A-Za-z])[+/_-]"),
        "case_turns": share("(?<=[a-z])[A-Z]"),
        "distinct_chars": F.size(F.array_distinct(F.split(c, ""))) / n, "dictionary": covered,
        "path_dummy": yes(F.col("path").rlike(DUMMIES)),
        "path_depth": F.size(F.split("path", "/")).cast("double"),
        "name_near": yes(name.rlike(NAMES) | sent),
        "assigned": yes(F.when(here, lead.rlike("""[=:]["']*$""")).otherwise(F.col("before").rlike("[=:]$") | sent)),
        "quoted": yes(F.concat("lead", "tail").rlike("[\"']")), "dummy_near": yes(around.rlike(DUMMIES))})


def _plain() -> Column:
    """Whether the candidate looks like a word or a number."""
    return ~F.col("candidate").rlike("[A-Za-z][0-9]|[0-9][A-Za-z]") & (F.col("case_turns") <= 0.12)


def weak_labels(rows: DataFrame) -> DataFrame:
    """Labels of the clear cases by form and assignment (see the module); null for the rest."""
    c, lead = F.col("candidate"), F.col("lead")
    plain = _plain()
    # a plain word after a name and a blank may be prose, one with dots code
    meant = ~plain | lead.rlike("""["']$""") | (lead.rlike("[=]$") & ~c.contains("."))
    named = (F.col("name_near") > 0) & (F.col("assigned") > 0) & (F.col("dummy_near") == 0) & meant
    clear = named | c.rlike(ISSUED) | F.col("before").rlike(PEM)
    none = (F.col("name_near") == 0) & (F.col("assigned") == 0) & (plain | c.rlike(UUID))
    none = none | (F.col("name_near") > 0) & (F.col("assigned") > 0) & c.rlike(DUMMIES)
    return rows.withColumn("label", F.when(clear, 1.0).when(none, 0.0))


def lessons(rows: DataFrame) -> DataFrame:
    """The labelled rows; once more those of label 1 without their name, and plain words of label 0 after one."""
    turned = ["name_near", "assigned", "quoted"]
    seen = F.struct(*turned)
    bare = F.struct(F.lit(0.0).alias("name_near"), F.lit(0.0).alias("assigned"), F.col("quoted"))
    prose = F.struct(*(F.lit(v).alias(n) for n, v in zip(turned, (1.0, 1.0, 0.0))))
    views = (F.when(F.col("label") == 1, F.array(seen, bare))
             .when(_plain() & (F.col("dummy_near") == 0), F.array(seen, prose)).otherwise(F.array(seen)))
    return (rows.where("label is not null").withColumn("view", F.explode(views.cast(
        "array<struct<name_near:double,assigned:double,quoted:double>>"))).drop(*turned)
            .select("*", "view.*").drop("view"))


def drawn(spark, each: int = 200) -> DataFrame:
    """Random keys of usual forms: hexadecimal, base64 and its web form, letters and digits; bare ones of 16 to 64
    characters and ones of 6 to 40 that are assigned to a name."""
    i = F.col("id").cast("string")
    much = F.concat(F.sha2(F.concat(F.lit("a"), i), 512), F.sha2(F.concat(F.lit("b"), i), 512))
    b64 = F.base64(F.unhex(much))
    forms = [F.substring(much, 1, 64), b64, F.translate(b64, "+/=", "-_A"), F.regexp_replace(b64, "[+/=]", ""),
             F.upper(much)]
    one_of = lambda *v: F.element_at(F.array(*map(F.lit, v)), (F.col("id") % len(v) + 1).cast("int"))
    none = [F.lit("").alias(n) for n in ("before", "after", "path")]
    bare = F.struct(one_of(16, 20, 24, 32, 40, 48, 64).alias("size"), F.lit("").alias("lead"), F.lit("").alias("tail"))
    named = F.struct(one_of(6, 7, 8, 9, 10, 12, 16, 24, 32, 40).alias("size"),
                     one_of("password=", 'token="', '"secret":"').alias("lead"), one_of("", '"', '"').alias("tail"))
    return (spark.range(each).select("id", F.explode(F.array(*forms)).alias("key"), F.array(bare, named)
                                     .cast("array<struct<size:int,lead:string,tail:string>>").alias("as"))
            .select("id", "key", F.explode("as").alias("as"))
            .select("id", F.left("key", "as.size").alias("candidate"), "as.lead", "as.tail", *none))


def _on_paths(taught: DataFrame, rows: DataFrame, most: int = 200) -> DataFrame:
    """``taught`` with the path features of a bounded, seeded sample of the corpus."""
    own = ["path_dummy", "path_depth"]
    some = (rows.select(*own).orderBy(F.xxhash64(F.lit(SEED), "candidate", "before", "lead", "path")).limit(most).collect())
    if not some:
        return taught
    at = F.element_at(F.array(*(F.struct(F.lit(r.path_dummy).alias(own[0]), F.lit(r.path_depth).alias(own[1]))
                                for r in some)), (F.pmod(F.xxhash64("candidate"), F.lit(len(some))) + 1).cast("int"))
    at = at.cast("struct<path_dummy:double,path_depth:double>")
    return taught.withColumn("at", at).drop(*own).select("*", "at.*").drop("at")


class Forest:
    def __init__(self, labelled: DataFrame, per_label: int = SAMPLE, seed: int = SEED,
                 columns: list[str] = FEATURES):
        self.columns = columns
        labelled = labelled.where("label is not null")
        counts = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
        self.only = float(next(iter(counts))) if len(counts) == 1 else 0.0
        self.model = None
        if len(counts) < 2:
            return
        quota = F.when(F.col("label") > 0, per_label / counts[1.0]).otherwise(per_label / counts[0.0])
        draw = F.pmod(F.xxhash64(F.lit(seed), "candidate", "before", "lead", "tail", "after", "path"), F.lit(1 << 20)) / (1 << 20)
        rows = self._vector(labelled.where(draw < quota)).select("label", "features")
        path = scratch_path(labelled.sparkSession, "secrets-train")
        rows.write.parquet(path)  # the trees read it level by level
        self.model = RandomForestClassifier(numTrees=40, maxDepth=10, seed=seed, cacheNodeIds=False).fit(
            labelled.sparkSession.read.parquet(path))

    def _vector(self, rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.columns, outputCol="features").transform(rows)

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` of features with ``score``, the forest's share for label 1."""
        if self.model is None:
            return rows.withColumn("score", F.lit(self.only))
        return (self.model.transform(self._vector(rows))
                .withColumn("score", vector_to_array("probability")[1])
                .drop("features", "rawPrediction", "probability", "prediction"))


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, *, id_col: str = "doc_id",
                 text_col: str = "text", path_col: str = "source",
                 threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, word_no, part, length, secret_sha256, masked and score of every finding that stays."""
    spark = docs.sparkSession
    known = dictionary(docs, text_col)
    path = scratch_path(spark, "secrets")
    features(candidates(docs, id_col=id_col, text_col=text_col, path_col=path_col), known).write.parquet(path)
    rows = spark.read.parquet(path)
    if labelled is None:
        rows = weak_labels(rows)
        taught = _on_paths(features(drawn(spark), known), rows).withColumn("label", F.lit(1.0))
        forest = Forest(lessons(rows).unionByName(taught, allowMissingColumns=True))
    else:
        forest = Forest(features(labelled, known))
    scored = forest.score(rows)
    c = F.col("candidate")
    return (scored.where(F.col("score") >= threshold)
            .select("doc_id", F.col("word_no").cast("long").alias("word_no"), "part",
                    F.length(c).cast("long").alias("length"), F.sha2(c, 256).alias("secret_sha256"),
                    F.concat(F.substring(c, 1, 4), F.lit("...")).alias("masked"), "score"))
