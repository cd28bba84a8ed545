"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Candidates are runs of at least 12 letters, digits and signs with a digit or with the beginning of a
usual service's keys, values of at least 8 characters assigned to a name such as password, and passwords
of at least 6 in addresses (scheme://user:password@host). The forest looks at each candidate's length, its
character transitions (changes of kind, and how usual its letter pairs are in words), how much of it a
dictionary covers, its path (the document's source and signs of paths or addresses around it) and the
neighbouring words. It is trained from labelled findings; ``labelled_findings`` derives a documented,
bounded set of them: ``TRAINING_ROWS`` rows of usual kinds of secrets and of strings taken for them.

A null text has no candidates, a null source is an empty path. Repeated rows are scanned one by one; a
null doc_id stays null. Texts are whole. An empty table gives an empty result. Columns of other names
are ignored, or kept as they are by ``redacted``. All steps are DataFrame expressions; the forest is
trained and applied by Spark's own library in the JVM.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.llm.common import stored, text_identity

TRAINING_ROWS = 4800
CONTEXT = 60
THRESHOLD = 0.5
MASK = "[SECRET]"

NAMES = "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth"
# How keys of usual services begin.
KNOWN_PREFIX = "AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk-|sk_live_|rk_live_|AIza|eyJ|npm_|SG\\.|ya29"
#: What stands before the password of an address.
ADDRESS_USER = r"://[^\s/:@]{1,64}:"
CANDIDATE = (
    rf"(?<![A-Za-z0-9_+/\-])(?:{KNOWN_PREFIX})[A-Za-z0-9_+/\-]{{12,}}+={{0,2}}"
    r"|(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*+[0-9])[A-Za-z0-9_+/\-]{12,}+={0,2}"
    rf"|(?<=[=:\"'] ?)(?<=(?i:{NAMES.replace('?', '{0,1}')})[\"']{{0,1}} {{0,1}}[=:] {{0,1}}[\"']{{0,1}})[^\s\"'<>,;]{{8,}}+"
    rf"|(?<=:)(?<={ADDRESS_USER})[^\s/@:]{{6,}}+(?=@)"
)

# Usual words of texts and programs, for coverage and usual letter pairs.
WORDS = """
about above access account action active address after again against album allow alpha also always amount angle animal answer apple
array article author available back balance base because before begin between block board body book border branch bridge bring build
business button cache call camera cancel card carry case center chain change channel chapter character charge check child choice
circle city class clean clear client close cloud code collect color column come command comment common company compare complete config
connect console contact content control copy count country course cover create current custom data database date debug default delete
delta demo department design detail device digital direct display document domain download driver each early east edge edit element
email empty enable encode engine enter entry error event every example execute export extend face false family feature field figure file
filter final find first flag float folder follow font force form format found frame free friend from function future garden general
global good green group guide half hand handle have head header health hello help here hidden high history home hour house http human
image import important include index info inner input insert inside install instance integer interest item join june keep kernel keyboard
know label language large last later layer layout lead learn left length letter level library light limit line link list little load local
location login logo long machine main make manager market master match matter media member memory menu message method middle minute mobile
model module money month more morning mount move music name native network never news next night node normal north note notice number
object office online only open option order other output owner package page panel paper parent part password past path pattern payment
people percent person phone photo picture place plain plan plate player point policy port position power present press price print private
process product profile program project property public query question quick random range read ready real record region release remote
render report request reset resource response rest result return right river road role room root round route rule sample save scale school
science screen script search second section security select self sender sequence server service session shadow share shell short show sign
simple single size small smart social some source south space special speed split stack staff standard start state static station status
step stop store stream street string strong student style subject submit summer super support switch symbol system table target task team
template test text that theme there thing this thread time title today token tool total trade train transfer travel tree true type under
union unique unit update upload user value variable vector version video view visible visit wait wall water week welcome west what wheel when
where white will window winter with word work world write year young zero zone
""".split()

# Words beside strings that are no secrets, and marks of placeholders.
HARMLESS = "sha1|sha256|sha512|md5|crc32|checksum|digest|commit|revision|hash|etag|uuid|guid|isbn|order|invoice|tracking|phone|card|serial|build|page|id"
PLACEHOLDER = "example|sample|dummy|changeme|change_me|placeholder|your[_-]|xxxx|0000|1234567|abcdef|test|todo|insert|redacted|foobar"


def pair_scores() -> dict[str, float]:
    """How usual each pair of letters is in words: log of its share against equal shares."""
    pairs = Counter(w[i : i + 2] for w in WORDS for i in range(len(w) - 1))
    total = sum(pairs.values())
    letters = [chr(c) for c in range(97, 123)]
    return {a + b: round(math.log((pairs[a + b] + 0.1) / (total + 67.6) * 676), 3) for a in letters for b in letters}


def features(candidate: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    size = F.greatest(F.length(candidate), F.lit(1)).cast("double")
    lower = F.lower(candidate)
    changes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    scores = F.array(*[F.lit(v) for _, v in sorted(pair_scores().items())])
    # Characters are read once into an array; neighbours find their score by position.
    place = F.transform(F.split(lower, ""), lambda c: F.ascii(c) - 97)
    following = F.slice(place, 2, F.greatest(F.size(place) - 1, F.lit(1)))
    pairs = F.transform(
        F.zip_with(place, following, lambda a, b: F.when(a.between(0, 25) & b.between(0, 25), a * 26 + b)),
        lambda at: F.coalesce(F.try_element_at(scores, at + 1), F.lit(-3.0)),
    )
    # The last character has no neighbour.
    pairs = F.slice(pairs, 1, F.greatest(F.size(place) - 1, F.lit(1)))
    covered = F.length(F.regexp_replace(lower, "|".join(sorted(WORDS, key=lambda w: (-len(w), w))), ""))

    def share(pattern: str) -> Column:
        return F.regexp_count(candidate, F.lit(pattern)) / size

    def flag(text: Column, pattern: str) -> Column:
        return text.rlike(pattern).cast("double")

    return {
        "f_length": size,
        "f_changes": F.regexp_count(candidate, F.lit(changes)) / size,
        "f_pairs": F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / size,
        "f_words": 1 - covered / size,
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_lower": share("[a-z]"),
        "f_signs": share("[^A-Za-z0-9]"),
        "f_different": F.size(F.array_distinct(F.split(candidate, ""))) / size,
        "f_hex": flag(candidate, "^[0-9a-f]+$"),
        "f_uuid": flag(candidate, "(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"),
        "f_prefix": flag(candidate, f"^({KNOWN_PREFIX})"),
        "f_placeholder": flag(lower, PLACEHOLDER),
        "f_in_path": (before.rlike(r"[/\\.@?&#%]$") | after.rlike(r"^[/\\.@?&#%]\S") | candidate.rlike("/.*/")).cast("double"),
        "f_in_address": flag(before, r"(?i)(https?|ftp|urn|mailto):\S*$"),
        "f_test_path": flag(path, "(?i)test|example|sample|mock|fixture|docs?/"),
        "f_named": flag(before, rf"(?i)({NAMES})[\"']?\s*[=:]?\s*[\"']?$"),
        "f_assigned": flag(before, r"[=:]\s*[\"']?$"),
        "f_credential": flag(before, rf"{ADDRESS_USER}$"),
        "f_quoted": flag(before, "[\"']$"),
        "f_near_name": flag(F.concat_ws(" ", before, after), rf"(?i)\b({NAMES})\b"),
        "f_near_harmless": flag(before, rf"(?i)\b({HARMLESS})\b[^A-Za-z]*$"),
    }


def labelled_findings(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """(candidate, before, after, path, label): kinds of strings in turn, with characters from a hash of the row number."""
    hexes = F.sha2(F.col("id").cast("string"), 512)
    mixed = F.translate(F.base64(F.unhex(hexes)), "=", "")
    upper = F.upper(F.translate(mixed, "+/01", "QZTW"))
    picks = [F.element_at(F.array(*map(F.lit, WORDS)), 1 + F.pmod(F.xxhash64("id", F.lit(i)), F.lit(len(WORDS))).cast("int")) for i in range(8)]

    def one_of(*options: str, salt: int = 9) -> Column:
        return F.element_at(F.array(*map(F.lit, options)), 1 + F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(options))).cast("int"))

    def cut(text: Column, least: int, most: int) -> Column:
        return F.substring(text, F.lit(1), least + F.pmod(F.xxhash64("id", F.lit(77)), F.lit(most - least + 1)).cast("int"))

    names = one_of("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "credentials", salt=11)
    assign = one_of("=", " = ", ": ", '="', " = \"", "='", ': "', salt=12)
    number = F.translate(F.substring(hexes, 1, 60), "abcdef", "123456")
    prose = F.concat_ws(" ", *picks[:3])
    harmless = one_of(*[w for w in HARMLESS.split("|")], salt=13)
    kinds: list[tuple[int, Column, Column]] = [
        (1, cut(hexes, 16, 64), F.concat(prose, F.lit(" "), names, assign)),
        (1, cut(mixed, 12, 44), F.concat(prose, F.lit(" "), names, assign)),
        (1, F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), F.concat(prose, one_of(" ", " key ", "=", ": ", salt=14))),
        (1, F.concat(one_of("ghp_", "gho_", "glpat-", "sk-", "sk_live_", "xoxb-", "AIza", "npm_", salt=15), cut(F.translate(mixed, "+/", "xy"), 20, 40)), F.concat(prose, one_of(" ", "=", ": ", " token ", salt=16))),
        (1, F.concat(picks[3], cut(number, 2, 5), one_of("!", "#", "$", "_", salt=17), picks[4]), F.concat(prose, F.lit(" "), names, assign)),
        (1, cut(mixed, 32, 60), F.concat(prose, one_of(" bearer ", " secret ", " token ", " private_key ", salt=18))),
        (0, cut(hexes, 32, 64), F.concat(prose, F.lit(" "), harmless, one_of(" ", ": ", "=", salt=19))),
        (0, F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.concat(prose, one_of(" ", " id ", " uuid ", salt=20))),
        (0, cut(number, 12, 19), F.concat(prose, one_of(" ", " card ", " phone ", " order ", salt=21))),
        (0, F.concat_ws("_", picks[3], picks[4], cut(number, 1, 4)), F.concat(prose, F.lit(" "))),
        (0, F.concat_ws("/", picks[3], picks[4], picks[5], cut(number, 1, 5)), F.concat(prose, one_of(" /", " https://www.", " ./", salt=22))),
        (0, F.concat(one_of("your_", "example_", "dummy", "changeme", "xxxx", "test_", salt=23), picks[3], cut(number, 1, 8)), F.concat(prose, F.lit(" "), names, assign)),
        (0, F.concat_ws("-", F.lit("2024"), F.substring(number, 1, 2), F.substring(number, 3, 2), picks[3]), F.concat(prose, F.lit(" "))),
        (0, F.concat(picks[3], picks[4], cut(number, 1, 3)), F.concat(prose, one_of(" ", " the ", " of ", salt=24))),
        (0, cut(hexes, 12, 40), F.concat(prose, one_of(" https://www.site.com/", " img/", " cache/", " build ", salt=25))),
        (0, F.concat_ws("_", picks[3], picks[4], picks[5]), F.concat(prose, F.lit(" "), names, assign)),
        (1, F.concat(picks[3], cut(mixed, 4, 16)), F.concat(prose, one_of(" https://", " postgres://", " amqp://", " redis://", salt=28), picks[6], F.lit(":"))),
        (0, F.concat_ws("-", picks[3], picks[4], cut(number, 1, 6)), F.concat(prose, one_of(" https://www.site.com/", " ftp://", " host:", salt=29))),
        (0, F.concat(F.lit("20"), *[x for i in (1, 3, 5) for x in (F.substring(number, i, 2), F.lit("-" if i < 5 else "T"))], cut(number, 2, 6)), F.concat(prose, one_of(" ", " at ", ": ", " since ", salt=30))),
    ]
    candidate, before, label = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, (kind, string, context) in enumerate(kinds):
        here = F.col("kind") == i
        candidate = F.when(here, string).otherwise(candidate)
        before = F.when(here, context).otherwise(before)
        label = F.when(here, float(kind)).otherwise(label)
    rows_ = spark.range(0, rows, 1, 1).withColumn("kind", F.col("id") % len(kinds))
    after = F.concat(one_of(" ", '" ', "' ", ". ", " \n", salt=26), F.concat_ws(" ", *picks[6:]))
    return rows_.select(candidate.alias("candidate"), before.alias("before"), after.alias("after"), one_of("", "src", "docs/", "tests/", salt=27).alias("path"), label.alias("label"))


def with_features(findings: DataFrame) -> DataFrame:
    given = features(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"))
    assembled = findings.withColumns(given)
    return VectorAssembler(inputCols=list(given), outputCol="features").transform(assembled).drop(*given)


def train_forest(findings: DataFrame, trees: int = 40, depth: int = 9) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=17)
    return forest.fit(stored(with_features(findings).select("features", "label"), "findings").coalesce(1))


def candidates(documents: DataFrame, keep: list[Column]) -> DataFrame:
    """One row per candidate with its context; a document without any has one row with nulls."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = documents.select(
        F.monotonically_increasing_id().alias("row"),
        *keep,
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.when(text.rlike(CANDIDATE), F.split(text, CANDIDATE, -1)).alias("between"),
    )
    kept = [c for c in found.columns if c not in ("found", "between")]
    spread = found.select(*kept, "between", F.posexplode_outer("found").alias("ordinal", "candidate"))
    before = F.element_at("between", F.col("ordinal") + 1)
    return spread.select(
        *kept,
        "ordinal",
        "candidate",
        F.length(before).cast("long").alias("gap"),
        F.right(before, F.lit(CONTEXT)).alias("before"),
        F.left(F.element_at("between", F.col("ordinal") + 2), F.lit(CONTEXT)).alias("after"),
    )


def scan(documents: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Per document: row, doc_id, text_hash, n_candidates, n_findings and findings (ordinal, secret, score)."""
    found = candidates(documents, text_identity())
    model.setFeaturesCol("features").setProbabilityCol("chances").setPredictionCol("verdict").setRawPredictionCol("votes")
    some = F.col("candidate").isNotNull()
    ready = found.withColumns({c: F.coalesce(c, F.lit("")) for c in ("before", "after")}).withColumn("given", some)
    judged = model.transform(with_features(ready.withColumn("candidate", F.coalesce("candidate", F.lit("")))))
    from pyspark.ml.functions import vector_to_array

    score = F.round(vector_to_array("chances")[1], 6)
    secret = F.col("given") & (F.col("score") >= THRESHOLD)
    rows = judged.select("row", "doc_id", "text_hash", "ordinal", "given", "candidate", score.alias("score"))
    finding = F.when(secret, F.struct("ordinal", F.col("candidate").alias("secret"), "score"))
    return rows.groupBy("row", "doc_id", "text_hash").agg(
        F.count_if("given").alias("n_candidates"),
        F.count_if(secret).alias("n_findings"),
        F.array_sort(F.collect_list(finding)).alias("findings"),
    )


def secret_findings(documents: DataFrame) -> DataFrame:
    """The scan of every document with a forest trained from the labelled findings."""
    return scan(documents, train_forest(labelled_findings(documents.sparkSession)))


def redacted(documents: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """All documents with all columns; secrets in texts are masked, and n_chars, if there, follows the text."""
    found = secret_findings(documents) if found is None else found
    secrets = F.array_sort(
        F.array_distinct(F.transform("findings", lambda f: f["secret"])),
        lambda a, b: F.length(b) - F.length(a),  # longer ones first, should one hold another
    )
    marked = found.filter("n_findings > 0").groupBy(F.col("doc_id").alias("_s_id"), F.col("text_hash").alias("_s_hash")).agg(
        F.first(secrets).alias("_secrets")
    )
    marked = stored(marked, "secrets")
    rows = documents.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text_identity()[1].alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_s_id")) & (F.col("_hash") == F.col("_s_hash"))
    masked = F.aggregate("_secrets", F.col("_row.text"), lambda text, s: F.replace(text, s, F.lit(MASK)))
    text = F.when(F.col("_secrets").isNotNull(), masked).otherwise(F.col("_row.text"))
    kinds = {f.name: f.dataType for f in documents.schema}
    columns = {"text": text}
    if "n_chars" in kinds:
        columns["n_chars"] = F.when(F.col("_secrets").isNotNull(), F.length(masked)).otherwise(F.col("_row.n_chars")).cast(kinds["n_chars"])
    return rows.join(marked, same, "left").select(*[columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])
