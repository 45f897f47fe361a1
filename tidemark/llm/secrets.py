"""Secret scan: candidates by pattern, false positives removed by a random forest.

DataFrame functions only. One pattern marks candidates in the text: long runs of
key-like characters with a digit or of mixed case, values assigned to a secret's name,
and private key blocks of any length, PGP and encrypted ones too. The text is cut there, so a candidate has its neighbours beside it. Features:
length, shares of character kinds, transitions between kinds, variety, coverage by a
dictionary, signs of a path or address, and words before and after. A forest learned
from labelled findings becomes one SQL expression, so scan and redaction run in the
row that holds the text, without a join or a shuffle of texts.

Labelled findings are made by rule: examples with a known outcome, and a bounded
sample of `most_rows` of the corpus's candidates that a rule labels, by smallest hash. The
fit is on that sample only; scan and redaction cover every candidate of every text.

Nulls: a null or empty text has no candidate and stays as it is. The characters U+0001
and U+0002 count as blanks when candidates are cut. Repeated rows are each scanned.
Extra columns stay untouched on redaction, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: A bounded sample: candidates of the corpus that the forest learns from.
MOST_ROWS = 4000
REPLACEMENT = "<SECRET>"

#: Names of secrets, words that tell of harmless values, a small dictionary.
SECRET_NAMES = "password passwd passphrase pwd secret token apikey api_key api-key access_key access-key auth credential private_key client_secret bearer".split()
HARMLESS_NAMES = "example sample dummy placeholder test commit checksum sha md5 hash uuid guid isbn version build digest etag integrity base64 image order invoice phone card account serial".split()
DICTIONARY = (
    "the and tion ing her for that with this have from which are was not you all can will one out about there when your what some time "
    "und der die das ein sch ich ung lich heit keit ver für den les des que une pour dans ment eau eux elle con los las para ción mente ado "
    "user name file path data page index image photo album document version order number report account service server config value"
).split()

# Each alternative fails at its first test nearly everywhere: inside a run, or away from a name's first letter.
_RUN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{16})(?:[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+|(?=[a-z+/_=-]*+[A-Z])(?=[A-Z+/_=-]*+[a-z])[A-Za-z+/_=-]++)"
_NAMED = r"(?<![A-Za-z0-9])(?=[" + "".join(sorted({c for n in SECRET_NAMES for c in (n[0], n[0].upper())})) + r"])(?i:" + "|".join(SECRET_NAMES) + r")[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?[^\s\"']{6,}"
# Up to the block's own END; possessive, so that the body costs no stack. A BEGIN or END of anything ends it.
_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_ID = r"(?<![A-Za-z0-9])A(?:KIA|SIA|IDA|ROA|GPA)[A-Z0-9]{16}(?![A-Za-z0-9])"
CANDIDATE = f"{_BLOCK}|{_NAMED}|{_RUN}|{_KEY_ID}"
FEATURES = "length digits lowers uppers hexes others kinds vowels variety words slashes dotted named quoted assigned harmless numbers_near address".split()


def _unmarked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\u0001"), F.lit(" ")), F.lit("\u0002"), F.lit(" "))


def pieces(text: Column) -> Column:
    """The text cut at its candidates: an odd number of pieces, those between are candidates."""
    plain = _unmarked(F.coalesce(text, F.lit("")))
    return F.split(F.regexp_replace(plain, f"({CANDIDATE})", "\u0001$1\u0002"), "[\u0001\u0002]")


def features(found: Column, before: Column, after: Column) -> Column:
    """The numbers that the forest sees, as array<double>."""
    value = F.regexp_replace(found, r"^(?i:[A-Za-z_-]+)[\"']?[ \t]*[:=][ \t]*[\"']?(?=.{6})", "")
    size = F.greatest(F.length(value), F.lit(1))
    near = F.lower(F.concat(F.right(before, F.lit(24)), F.lit(" "), F.regexp_extract(found, r"^[A-Za-z_-]+[\"']?[ \t]*[:=]", 0)))

    def share(pattern: str) -> Column:
        return (size - F.length(F.regexp_replace(value, pattern, ""))) / size

    # The kind of each character, then where the next one is of another kind.
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    turns = F.length(F.regexp_replace(F.regexp_replace(kinds, r"(.)\1+", "$1"), "(?s)^.", "")) / size
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    names, harmless = "|".join(SECRET_NAMES), "|".join(HARMLESS_NAMES)
    numbers = [
        F.least(size, F.lit(200)),
        share("[0-9]"),
        share("[a-z]"),
        share("[A-Z]"),
        share("[0-9a-fA-F]"),
        share("[A-Za-z0-9]") * -1 + 1,
        turns,
        share("[aeiouAEIOU]"),
        F.size(F.array_distinct(F.split(F.left(value, F.lit(200)), ""))) / F.least(size, F.lit(200)),
        (size - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))) / size,
        (F.length(value) - F.length(F.replace(value, F.lit("/"), F.lit("")))) / size,
        flag(before.rlike(r"[./@\\]$") | after.rlike(r"^[./@\\][A-Za-z0-9]")),
        flag(near.rlike(f"(?:{names})[\"']?\\s*[:=]?\\s*[\"']?\\s*$")),
        flag(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")),
        flag(before.rlike(r"[:=]\s*[\"']?$") | found.rlike(r"^[A-Za-z_-]+[\"']?[ \t]*[:=]")),
        flag(near.rlike(f"(?:^|[^a-z])(?:{harmless})[^a-z]") | F.lower(F.left(after, F.lit(24))).rlike(f"^\\W*(?:{harmless})")),
        flag(before.rlike(r"[0-9]\s?$") | after.rlike(r"^\s?[0-9]")),
        flag(before.rlike(r"(?i)(?:https?://|www\.|data:)\S*$")),
    ]
    return F.array(*[n.cast("double") for n in numbers])


def candidates(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate: the kept columns, its number in the text, itself and its neighbours."""
    cut = documents.select(*keep, pieces(F.col("text")).alias("cut")).filter("size(cut) > 1")
    at = F.explode(F.sequence(F.lit(1), F.size("cut") - 2, F.lit(2))).alias("at")
    each = cut.select(*keep, "cut", at)
    return each.select(
        *keep,
        "at",
        F.get("cut", F.col("at")).alias("found"),
        F.right(F.get("cut", F.col("at") - 1), F.lit(40)).alias("before"),
        F.left(F.get("cut", F.col("at") + 1), F.lit(40)).alias("after"),
        F.length(F.get("cut", F.col("at") - 1)).alias("gap"),
    )


def examples(spark: SparkSession, each: int = 60) -> DataFrame:
    """Labelled findings of known outcome: (found, before, after, label)."""
    n = spark.range(each, numPartitions=1).select(F.col("id").cast("string").alias("i"))
    hexes, more = F.sha1("i"), F.sha2(F.concat("i", F.lit("x")), 256)
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(more)), "[^A-Za-z0-9]", ""))
    mixed = F.regexp_replace(F.base64(F.unhex(more)), "[^A-Za-z0-9]", "")
    digits = F.regexp_replace(F.conv(F.substring(more, 1, 15), 16, 10), "[^0-9]", "")
    dashed = F.concat_ws("-", F.substring(more, 1, 8), F.substring(more, 9, 4), F.substring(more, 13, 4), F.substring(more, 17, 4), F.substring(more, 21, 12))
    letters = F.translate(mixed, "0123456789", "QxRyTzUvWk")
    word = lambda k: F.get(F.array(*map(F.lit, DICTIONARY)), (F.col("i").cast("int") * 7 + k) % len(DICTIONARY))
    rows = [
        (F.concat(F.lit("AKIA"), F.left(upper, F.lit(16))), "the key is ", " of the account", 1),
        (F.concat(F.lit("AKIA"), F.left(upper, F.lit(16))), "stth of thon ", " thand er", 1),
        (F.concat(F.lit("password="), F.left(more, F.lit(18))), "set ", " and go on", 1),
        (F.concat(F.lit("token = \""), hexes), "with ", "\" in it", 1),
        (F.concat(F.lit("api_key: "), F.left(mixed, F.lit(32))), "use ", "\n", 1),
        (F.concat(F.lit("ghp_"), F.left(F.concat(mixed, mixed), F.lit(36))), "git ", " now", 1),
        (F.concat(F.lit("xoxb-"), F.left(digits, F.lit(12)), F.lit("-"), F.left(mixed, F.lit(24))), "slack ", "\n", 1),
        (F.concat(F.lit("secret='"), F.left(mixed, F.lit(24))), "a ", "' b", 1),
        (F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), mixed, mixed, F.lit("\n-----END PRIVATE KEY-----")), "\n", "\n", 1),
        (F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,"), F.upper(hexes), F.lit("\n\n"), mixed, mixed, F.lit("\n-----END RSA PRIVATE KEY-----")), "\n", "\n", 1),
        (F.concat(F.lit("-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n"), mixed, mixed, F.lit("\n=xYz1\n-----END PGP PRIVATE KEY BLOCK-----")), "\n", "\n", 1),
        (F.left(letters, F.lit(24)), "use ", " now", 1),
        (F.left(letters, F.lit(32)), "onthre ", " Edthnd", 1),
        (F.concat(word(0), F.initcap(word(31)), F.initcap(word(12)), F.initcap(word(47)), F.initcap(word(5))), "call ", " here", 0),
        (F.concat(F.initcap(word(3)), F.lit("-"), word(17), F.lit("-"), word(40), F.lit("-"), word(26)), "the ", " one", 0),
        (F.concat(word(9), F.lit("/"), F.initcap(word(22)), F.lit("/"), word(35), F.lit("_"), word(50)), "in /", ".txt", 0),
        (hexes, "commit ", " fixes it", 0),
        (hexes, "the checksum is ", ".", 0),
        (more, "sha256 ", " of the file", 0),
        (dashed, "the uuid ", " names it", 0),
        (dashed, "see ", " there", 0),
        (F.left(F.concat(F.lit("4"), digits, digits), F.lit(16)), "onthre ", " Edthnd", 0),
        (F.left(F.concat(digits, digits), F.lit(16)), "the order ", " came", 0),
        (F.concat(F.lit("photos/album"), F.left(digits, F.lit(4)), F.lit("/image_"), F.left(digits, F.lit(3))), "https://www.site.org/", ".png", 0),
        (F.concat(F.lit("thenationalreport"), F.left(digits, F.lit(4))), "see the ", " page", 0),
        (F.concat(F.lit("usr/share/document-"), F.left(digits, F.lit(2))), "in /", ".txt", 0),
        (F.concat(F.lit("token: example"), F.left(digits, F.lit(2))), "such as ", " here", 0),
        (F.concat(F.lit("password: changetheword"), F.left(digits, F.lit(1))), "a sample ", " here", 0),
        (F.concat(F.lit("iVBORw0KGgo"), mixed), "data:image/png;base64,", "\" alt", 0),
    ]
    made = [n.select(found.alias("found"), F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(label).alias("label")) for found, before, after, label in rows]
    out = made[0]
    for other in made[1:]:
        out = out.unionAll(other)
    return out


def labelled(found: Column, before: Column, after: Column) -> Column:
    """A finding's label where its form leaves no doubt, else NULL."""
    sure = found.rlike(r"^AKIA[0-9A-Z]{16}$") | found.rlike(r"^(?i:password|passwd|token|secret|api_key)\s?=\s?[\"']?[0-9a-f]{16,}$") | found.startswith("-----BEGIN ")
    harmless = found.rlike(r"^[0-9]+$") | found.rlike(r"^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$") | F.lower(before).rlike(r"(?:commit|checksum|sha1|sha256|md5|uuid|isbn)\W*$")
    return F.when(sure & ~F.lower(before).rlike(r"example\W*$"), 1).when(harmless, 0)


def findings(documents: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """The labelled examples and a bounded sample of the corpus's candidates that a rule labels."""
    found = candidates(documents).select("found", "before", "after", labelled(F.col("found"), F.col("before"), F.col("after")).alias("label"))
    order = [F.xxhash64("found", "before", "after"), F.col("found"), F.col("before"), F.col("after")]
    some = found.filter("label is not null").distinct().orderBy(*order).limit(most_rows)
    # The learner reads its input many times, so the sample is written once.
    return stored(examples(documents.sparkSession).unionAll(some), "findings")


def forest(rows: DataFrame, trees: int = 16, depth: int = 5, seed: int = 7) -> list:
    """Learn from (found, before, after, label): a list of trees, a leaf is the chance of a secret."""
    made = rows.select(features(F.col("found"), F.col("before"), F.col("after")).alias("f"), F.col("label").cast("double").alias("label"), F.xxhash64("found", "before", "after").alias("h"))
    made = made.coalesce(1).sortWithinPartitions("h", "label").select(array_to_vector("f").alias("features"), "label")
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", minInstancesPerNode=2)
    model = learner.fit(made)

    def read(node):
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return stats[1] / max(sum(stats), 1e-9) if len(stats) > 1 else 0.0
        return node.split().featureIndex(), node.split().threshold(), read(node.leftChild()), read(node.rightChild())

    return [read(tree._java_obj.rootNode()) for tree in model.trees]


def chance(trees: list, values: Column) -> Column:
    """The forest as an expression over array<double>: the mean of its trees."""

    def expression(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        at, limit, left, right = node
        return F.when(F.get(values, F.lit(at)) <= limit, expression(left)).otherwise(expression(right))

    total = expression(trees[0])
    for tree in trees[1:]:
        total = total + expression(tree)
    return total / len(trees)


def scan(documents: DataFrame, threshold: float = 0.5, most_rows: int = MOST_ROWS) -> DataFrame:
    """Every candidate: doc_id, start and length in characters, found, probability, is_secret."""
    trees = forest(findings(documents, most_rows))
    keyed = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    values = features(F.col("found"), F.col("before"), F.col("after"))
    # The lambda holds the features, so that they are worked out once and not at each split of each tree.
    scored = candidates(keyed, "doc_id", "row").withColumn("probability", F.transform(F.array(values), lambda v: chance(trees, v))[0])
    passed = F.expr("sum(gap + length(found)) over (partition by row order by at rows unbounded preceding)")
    placed = scored.withColumn("start", passed - F.length("found"))
    return placed.select("doc_id", "start", F.length("found").alias("length"), "found", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def redact(documents: DataFrame, threshold: float = 0.5, most_rows: int = MOST_ROWS) -> DataFrame:
    """The documents with each secret in `text` replaced; no row goes, no other column changes."""
    trees = forest(findings(documents, most_rows))
    cut = pieces(F.col("text"))

    def each(all_pieces: Column) -> Column:
        def one(piece: Column, i: Column) -> Column:
            before, after = F.right(F.get(all_pieces, i - 1), F.lit(40)), F.left(F.get(all_pieces, i + 1), F.lit(40))
            secret = F.transform(F.array(features(piece, before, after)), lambda v: chance(trees, v) >= threshold)[0]
            return F.when((i % 2 == 1) & secret, F.lit(REPLACEMENT)).otherwise(piece)

        return F.array_join(F.transform(all_pieces, one), "")

    # The text itself stays unless a secret was found, so blanks are not put for control characters.
    changed = F.transform(F.array(cut), lambda p: F.when(F.size(p) > 1, each(p)))[0]
    same = _unmarked(F.col("text"))
    return documents.withColumn("text", F.transform(F.array(changed), lambda c: F.when(c.isNull() | (c == same), F.col("text")).otherwise(c))[0])
