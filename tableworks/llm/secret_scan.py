"""Secret scan: regular expressions propose, a random forest removes false positives.

A candidate is a run of at least ``MIN_LENGTH`` key-like characters, '=' only as
padding at its end, or a value of ``MIN_NAMED`` or more signs of any kind that is
assigned to a secret's name; a name that is assigned a value is none.  An unquoted
value ends before white space, quotes and any of , ; < > &.  A candidate's
features are its length, how its characters follow each other, how much of it
dictionary words cover, whether it sits in a path or address, and the words next
to it.  A random forest trained on labelled findings gives each candidate a
score.  All of it is DataFrame functions and Spark's own tree learner; the
candidates of a text are found inside its row, so nothing is shuffled but the
learner's statistics.

``labelled_findings`` derives labels where none are at hand: secrets are a
fixed-length hex string or mixed base64 assigned to a name that says key, token,
secret or password, a mixed value of a password, and strings with a known prefix;
runs without digits, without letters or with hardly any different characters
are none; the rest stays unlabelled and is left to the forest.  ``examples`` adds
made-up ones of each shape, so the forest knows shapes that a table hardly holds.

Defined results: null, empty and blank texts have no candidate; a candidate at
the very start or end of a text has empty neighbours; repeated rows repeat their
findings; a null id is kept and counts as training data; where ``known`` has
not both classes the score is 1 for candidates labelled secret and 0 for all others; an
empty table gives an empty result; other columns are ignored, and
``redact_secrets`` passes them unchanged.
"""

from __future__ import annotations

import random
import string

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.llm.common import written

MIN_LENGTH, MIN_NAMED = 16, 6
TREES, DEPTH = 20, 6
THRESHOLD = 0.5

# Key-like characters; names of secrets; common words of four
# languages and of addresses, for dictionary coverage.
KEY_CHARS = "A-Za-z0-9+/_-"
_NAMES = ("key|api|pwd", "auth", "token", "secret|passwd", "password", "credential|passphrase")  # by length: look-behinds are of fixed width
_ENDS = ("[=:]", "[=:] ", "[=:][\"'`]", "[=:] [\"'`]")


def _after_name(end: str) -> str:
    """Behind a secret's name and an assignment that ends in ``end``."""
    names = "|".join(f"(?<=(?i:{n}){quote}{space}{end})" for n in _NAMES for quote in ("", "[\"']") for space in ("", " "))
    return f"(?<={end})(?:{names})"


_BARE = rf"(?!(?i:bearer|basic) )[^\s\"'`,;<>&]{{{MIN_NAMED - 1},}}[^\s\"'`,;<>&.:!?)\]}}]"
_QUOTED = rf"[^\s\"'`]{{{MIN_NAMED},}}"
_NAMED = "|".join([*[f"(?:{_after_name(e)}){_QUOTED if '`' in e else _BARE}" for e in _ENDS], rf"(?:(?<=(?i:bearer) )|(?<=(?i:auth|tion): (?i:basic) )){_BARE}"])
_IS_NAME = (
    r"[A-Za-z0-9_-]*(?i:key|token|secret|passw(?:or)?d|passphrase|pwd|auth|credential|api)[A-Za-z0-9_-]{0,16}"
    rf"[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"'`]?[{KEY_CHARS}]"
)
_RUN = rf"(?<![{KEY_CHARS}])(?=[{KEY_CHARS}]{{{MIN_LENGTH}}})(?!{_IS_NAME})[{KEY_CHARS}]{{{MIN_LENGTH},}}+(?:={{1,2}}(?![={KEY_CHARS}]))?"
CANDIDATE = f"(?:(?<=[=: \"'`])(?:{_NAMED})|{_RUN})"
KNOWN_PREFIX = (
    r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[opusr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w-]{20,}|xox[abprs]-[\w-]{10,}|(sk|pk|rk)[_-](live|test|proj|ant)[\w-]{16,}"
    r"|AIza[\w-]{35}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}|SG\.[\w-]{16,})"
)
SECRET_NAMES = r"(?i)(key|token|secret|passw(or)?d|pwd|auth|bearer|credential|api)"
DICTIONARY = (
    "about after again also and because been before being between both can come could day did down each even every "
    "first for from get give good great had has have her here him his how into its just know like long look made make "
    "many may more most much must name new not now number one only other our out over own part people place said same "
    "see she should some such take than that the their them then there these they thing think this those time tion "
    "ing ent ion two under use very was way well were what when where which while who will with work world would year "
    "you your der die das und ein eine ist nicht mit von den dem auch auf für sich wird sind ver ung lich keit heit "
    "les des une est que qui dans pour pas sur plus avec par sont ment eau oui leur los las del una por con para como "
    "pero más este esta cion mente ado ador http https www com org net html index file path user home data image"
).split()

FEATURES = (
    "length", "digits", "upper", "lower", "signs", "class_changes", "digit_letter", "vowel_pairs", "consonant_runs",
    "distinct", "longest_repeat", "dictionary", "hex", "in_path", "slashes", "named", "assigned", "quoted", "word_before", "word_after",
    "prefixed",
)


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("double")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, place, candidate, before, after): each candidate with the text beside it."""
    return _findings_of_rows(docs, id_col, text_col).drop("text_hash")


def _findings_of_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The ``findings`` with the ``text_hash`` that tells rows of one id apart."""
    text = F.col(f"`{text_col}`")
    some = docs.filter(text.rlike(CANDIDATE)).select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    gaps = F.split("text", CANDIDATE, -1)
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    # only the ends of the gaps are kept
    sides = F.transform(gaps, lambda g: F.struct(F.substring(g, -48, 48).alias("tail"), F.substring(g, 1, 48).alias("head")))
    rows = some.select("id", "text_hash", found.alias("found"), sides.alias("sides"))
    rows = rows.select("id", "text_hash", F.posexplode(F.arrays_zip(F.col("found").alias("found"), F.col("sides").alias("sides"), F.slice("sides", 2, F.greatest(F.size("found"), F.lit(1))).alias("next"))).alias("place", "x"))
    return rows.filter(F.col("x.found").isNotNull()).select(
        "id", (F.col("place") + 1).alias("place"), F.col("x.found").alias("candidate"),
        F.coalesce(F.col("x.sides.tail"), F.lit("")).alias("before"), F.coalesce(F.col("x.next.head"), F.lit("")).alias("after"), "text_hash",
    )


def with_features(found: DataFrame) -> DataFrame:
    """``found`` with one double per feature."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    n = F.length(c).cast("double")
    chars = F.split(c, "")
    words = "|".join(sorted((w for w in DICTIONARY if len(w) >= 3), key=lambda w: (-len(w), w)))
    named = before.rlike(SECRET_NAMES + r"\w*\W{0,6}$")
    values = {
        "length": n,
        "digits": _count(c, "[0-9]") / n,
        "upper": _count(c, "[A-Z]") / n,
        "lower": _count(c, "[a-z]") / n,
        "signs": _count(c, "[^A-Za-z0-9]") / n,
        "class_changes": _count(c, "(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])") / n,
        "digit_letter": _count(c, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])") / n,
        "vowel_pairs": _count(c, "(?i)(?<=[aeiouy])(?=[bcdfghjklmnpqrstvwxz])|(?<=[bcdfghjklmnpqrstvwxz])(?=[aeiouy])") / n,
        "consonant_runs": _count(c, "(?i)[bcdfghjklmnpqrstvwxz]{4,}"),
        "distinct": F.size(F.array_distinct(chars)).cast("double") / n,
        "longest_repeat": _count(c, r"(.)\1") / n,
        "dictionary": (n - F.length(F.regexp_replace(F.lower(c), words, ""))) / n,
        "hex": F.when(c.rlike("^[0-9a-f]+$") | c.rlike("^[0-9A-F]+$"), 1.0).otherwise(0.0),
        "in_path": F.when(before.rlike(r"(://\S*|[/\\.@])$") | after.rlike(r"^[.@\\]\w"), 1.0).otherwise(0.0),
        "slashes": _count(c, "/") / n,
        "named": F.when(named, 1.0).otherwise(0.0),
        "assigned": F.when(before.rlike(r"[=:]\s*[\"'`]?$"), 1.0).otherwise(0.0),
        "quoted": F.when(before.rlike("[\"'`]$") & after.rlike("^[\"'`]"), 1.0).otherwise(0.0),
        "word_before": F.when(before.rlike(r"\p{L}{2,}\W{0,2}$"), 1.0).otherwise(0.0),
        "word_after": F.when(after.rlike(r"^\W{0,2}\p{L}{2,}"), 1.0).otherwise(0.0),
        "prefixed": F.when(c.rlike(KNOWN_PREFIX), 1.0).otherwise(0.0),
    }
    return found.select(*found.columns, *[values[f].alias(f) for f in FEATURES])


def labelled_findings() -> Column:
    """1 (secret), 0 (not) or null, from what can be said for sure about a finding."""
    c, before = F.col("candidate"), F.col("before")
    body = F.regexp_replace(c, "=+$", "")
    is_value = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("in_path") == 0)
    hexadecimal = body.rlike("^(?i)([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$") & (F.col("named") == 1) & (F.col("assigned") == 1)
    mixed = c.rlike("[0-9]") & c.rlike("[a-z]") & c.rlike("[A-Z]")
    base64 = body.rlike(rf"^[{KEY_CHARS}]{{20,}}$") & is_value & mixed & (F.col("distinct") * F.col("length") >= 12) & (F.col("dictionary") < 0.4)
    of_password = before.rlike(r"(?i)(passw(or)?d|passphrase|pwd|secret)\w*[\"']?\s{0,3}[=:]\s{0,3}[\"'`]?$")
    password = of_password & (F.col("length") >= 8) & mixed & ~c.contains("://") & (F.col("distinct") * F.col("length") >= 6)
    sure = hexadecimal | base64 | password | (F.col("prefixed") == 1)
    never = ~c.rlike("[0-9]") | ~c.rlike("[A-Za-z]") | (F.col("distinct") * F.col("length") <= 5)
    return F.when(sure & before.isNotNull(), 1).when(never, 0)


EXAMPLES = 40  # of each shape


def examples() -> list[tuple[str, str, str, int]]:
    """(candidate, before, after, label): made-up findings of every shape, always the same."""
    rng, out = random.Random(1), []
    letters, both = string.ascii_lowercase, string.ascii_letters + string.digits
    draw = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    names = ["key", "api_key", "API_KEY", "token", "access_token", "API_TOKEN", "client_secret", "SECRET_KEY", "auth", "credential"]
    joins = ["=", ": ", " = ", ' = "', ': "', '="', '": "', "='"]

    def placed(c: str, name: str, join: str) -> tuple[str, str]:
        start = rng.choice(["", "\n", "some words ", "https://a.example/x?"]) + name + join
        return start, join[-1] + rng.choice([" and more", "\n", ""]) if join[-1] in "\"'" else rng.choice([" and more", "\n", "&x=1", ""])

    for _ in range(EXAMPLES):
        keys = [draw("0123456789abcdef", rng.choice([32, 40, 64])), draw(both + "+/", rng.randrange(20, 60)) + rng.choice(["", "=", "=="]), draw(both, rng.randrange(18, 50))]
        out += [(k, *placed(k, rng.choice(names), rng.choice(joins)), 1) for k in keys]
        word = draw(letters, rng.randrange(3, 7)).title() + draw(string.digits, rng.randrange(1, 4)) + draw(letters, rng.randrange(1, 4)) + draw("&!#%*$@", rng.randrange(0, 3)) + draw(both, rng.randrange(1, 6))
        out.append((word, *placed(word, rng.choice(["password", "passwd", "db_password", "PWD", "secret", "DB_PASSWORD"]), rng.choice(joins)), 1))
        known = rng.choice(["AKIA" + draw(string.ascii_uppercase + string.digits, 16), "ghp_" + draw(both, 36), "xoxb-" + draw(string.digits, 12) + "-" + draw(both, 24), "AIza" + draw(both, 35), "hf_" + draw(both, 34)])
        out.append((known, *rng.choice([("see ", " here"), ("", ""), ("it was ", "."), placed(known, rng.choice(names), rng.choice(joins))]), 1))
        path = "/".join(draw(letters, rng.randrange(3, 9)) + rng.choice(["", draw(string.digits, 2)]) for _ in range(5))
        out += [(path, "https://www.example", rng.choice(["", ".html", " and more"]), 0), (f"{draw(letters, 8)}-{draw(letters, 7)}-{rng.randrange(2000, 2030)}", "the ", " of it", 0)]
        out += [(draw("0123456789abcdef", 40), "commit ", " of the branch", 0), (draw(letters, rng.randrange(6, 10)), placed("", rng.choice(names), ": ")[0], " more", 0)]
    return out


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel | None:
    """A forest over all rows with features and a 0/1 ``label``; None without both classes."""
    if labelled.select("label").distinct().count() < 2:
        return None
    rows = labelled.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*FEATURES)).alias("features"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=1).fit(rows)


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, place, candidate, before, after, held_out, score, is_secret, text_hash) of every candidate.

    ``known`` holds labelled findings (id, place, label); by default labels are
    derived, and only those outside the held-out fold and ``examples`` are learned from.
    """
    found = written(with_features(_findings_of_rows(docs, id_col, text_col)), "findings")
    if known is None:
        labelled = found.withColumn("label", labelled_findings()).filter(F.col("label").isNotNull() & ~held_out(F.col("id")))
        made_up = with_features(docs.sparkSession.createDataFrame(examples(), "candidate string, before string, after string, label int"))
        labelled = labelled.select("label", *FEATURES).unionByName(made_up.select("label", *FEATURES))
    else:
        labelled = found.join(known.select("id", "place", F.col("label").cast("int").alias("label")), ["id", "place"]).filter("label in (0, 1)")
    forest = train(labelled)
    if forest is None:
        scored = found.withColumn("score", F.when(F.coalesce(labelled_findings(), F.lit(0)) == 1, 1.0).otherwise(0.0))
    else:
        ready = found.withColumn("features", array_to_vector(F.array(*FEATURES)))
        scored = forest.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        F.col("id").alias(id_col), "place", "candidate", "before", "after", held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).alias("is_secret"), "text_hash",
    )


def redact_secrets(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with the candidates judged secret replaced by ``mark``.

    A row is found by its id and its text's hash, so rows that share an id, or have
    none, each lose their own candidates only.
    """
    text = F.col(f"`{text_col}`")
    key = [F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")]
    places = scanned.filter("is_secret").groupBy(*key).agg(F.collect_set("place").alias("__places"))
    joined = docs.join(places, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    fills = F.transform(found, lambda f, i: F.when(F.array_contains("__places", i + 1), F.lit(mark)).otherwise(f))
    clean = F.array_join(F.zip_with(F.split(text, CANDIDATE, -1), F.concat(fills, F.array(F.lit(""))), lambda g, f: F.concat(g, f)), "")
    return joined.withColumn(text_col, F.when(F.col("__places").isNull(), text).otherwise(clean)).select(*docs.columns)
