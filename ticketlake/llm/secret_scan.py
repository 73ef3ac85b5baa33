"""Secret scans with a random forest that removes false positives.

The scan is wide: a candidate is any value after a naming word, the value of user:value@host,
and a long run of key characters with a digit, mixed case or a known prefix. Names before an
equals sign are neighbours of a candidate, not part of it. Features are length, character
transitions, coverage by the corpus's own dictionary, path signs and neighbouring words; a
random forest trained on labelled findings gives each candidate a score. All steps are
DataFrame operations on the JVM.
"""

from __future__ import annotations

import math
import re
from string import ascii_lowercase

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.text import bucket_of, materialize, take_sample, words_of

KEY = "[A-Za-z0-9+/_=\\-]"
# Words that name a secret, and beginnings of keys in use.
SECRET_NAMES = (
    "token", "secret", "passw", "passphrase", "pwd", "private", "api_key", "api-key", "apikey", "auth",
    "access_key", "access-key", "accesskey", "bearer", "credential",
)
KEY_STARTS = (
    "AKIA", "ASIA", "AGPA", "AIDA", "AROA", "ANPA", "gho_", "ghp_", "ghr_", "ghs_", "ghu_", "github_pat_", "glpat-",
    "sk-", "rk_live_", "sk_live_", "xoxa", "xoxb", "xoxe", "xoxp", "xoxr", "xoxs", "AIza", "ya29", "npm_", "pypi-", "hf_", "eyJ",
)


def _any(words: tuple[str, ...]) -> str:
    """Pattern of any of the words, grouped by first letter: one look rules most places out."""
    firsts: dict[str, list[str]] = {}
    for w in words:
        firsts.setdefault(w[0].lower(), []).append(re.escape(w[1:]))
    return "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in firsts.items())


# "pass" names a secret only where it is a word of its own before a value.
NAMES = f"(?i:{_any(SECRET_NAMES)}|pass(?=[\"'`]?[ \t]*+[=:]))"
KNOWN = f"(?i:{_any(KEY_STARTS)})"
# Loops over groups are possessive: Java runs those without recursion, so values may be long.
_NAMED = (
    f"{NAMES}[A-Za-z0-9_-]*+[\"'`\\])]?[ \\t]*+(?::=|=>|==|[=:])[ \\t]*+(?:(?i:bearer|basic|token)[ \\t]++)?"
    f"|(?i:bearer)[ \\t]++|(?<![A-Za-z0-9-])--?(?:[A-Za-z0-9]++-)*?{NAMES}[A-Za-z0-9_-]*+[ \\t]++(?!-)"
)
# Two letters rule most places out before the alternatives are tried; so does the colon below.
_GUARD = "(?=[aAbBcCpPsStT-])(?=[aA][cCpPuU]|[bB][eE]|[cC][rR]|[pP][aArRwW]|[sS][eE]|[tT][oO]|-)"
# Up to a blank, a quote or the next name=; punctuation before a blank is not part of it.
_OPEN = (
    "(?:(?![&;,?][A-Za-z0-9_.-]++=)(?![.,;:)\\]}]{1,8}+(?:[\\s\"'`<>]|$))[^\\s\"'`<>])++"
)
_VALUE = "|".join(f"(?<={q})(?:\\\\.|[^{q}\\\\\r\n])++(?={q})" for q in "\"'`") + f"|{_OPEN}"
_USER = "[A-Za-z][A-Za-z0-9+.-]*+://[^\\s/:@\"'<>]*+:|(?<!:)[A-Za-z0-9._%+-]++:(?!/)"
_RUN = (
    f"(?:(?=[A-Za-z+/_=\\-]*+[0-9])|(?={KEY}*?[a-z])(?={KEY}+?[A-Z])|(?={KNOWN})){KEY}{{16,}}+"
)
#: Groups 1 to 3 are what stands before the candidate in a match.
PATTERN = (
    f"{_GUARD}((?:{_NAMED})[\"'`]?)(?:{_VALUE})"
    f"|(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9._%+-]++:)((?:{_USER}))(?:[^\\s/@\"'<>]|@(?=[^\\s/@\"'<>]++@))++(?=@[A-Za-z0-9\\[])"
    f"|(?<!{KEY})(?={KEY}{{16}})(?!{KEY}*?{NAMES}[A-Za-z0-9_-]*+=[A-Za-z0-9+/_-])((?:[A-Za-z0-9+/_\\-]++=(?!=)){{0,8}}){_RUN}"
)
#: Code points of context on either side.
CONTEXT = 40
#: Words next to a candidate that speak for a secret, and that speak for something else.
SECRET_WORDS = "token|secret|passw|passphrase|\\bpass\\b|pwd|api[_-]?key|apikey|auth|bearer|credential|private|access[_-]?key"
OTHER_WORDS = (
    "commit|sha1|sha256|md5|hash|checksum|digest|uuid|guid|build|version|order|invoice|isbn|phone|page|"
    "image|file|path|href|http|www"
)
PLACEHOLDERS = "example|sample|dummy|your|xxxx|change|placeholder|test|0000|1234567"
#: Least share of all words that a word of the dictionary has, so it holds a million at most;
#: bound of the texts that labelled findings are planted in.
LEAST_SHARE, MAX_FINDINGS = 1e-6, 4_000
FEATURES = (
    "length", "digits", "uppers", "distinct", "switches", "longest_run", "transitions", "coverage",
    "slashes", "path_before", "secret_words", "other_words", "assigned", "quoted", "placeholder",
    "signs", "known_prefix", "user_before", "word_like",
)
#: Labelled lines of each kind per text.
ROUNDS = 4
TREES, DEPTH = 24, 6
#: Cost of a letter pair that no word has.
UNSEEN = 8.0
MASK = "[SECRET]"


# Candidates -----------------------------------------------------------------------------
def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, candidate, before, after) per candidate of every whole text.

    ``start`` counts code points from 0. Null texts have none; a repeated row repeats its
    candidates.
    """
    found = docs.filter(F.col("text").rlike(PATTERN)).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"),
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"),
        F.split("text", PATTERN, -1).alias("gaps"),
        *[F.regexp_extract_all("text", F.lit(PATTERN), F.lit(g)).alias(f"g{g}") for g in (1, 2, 3)],
    )
    # A match starts after the gaps and matches before it; the value follows what stands before.
    spans = F.expr(
        "aggregate(arrays_zip(found, gaps, g1, g2, g3), named_struct('at', 0, 'out',"
        " CAST(array() AS ARRAY<STRUCT<start: INT, candidate: STRING>>)),"
        " (a, m) -> IF(m.found IS NULL, a, transform(array(char_length(m.g1) + char_length(m.g2) + char_length(m.g3)), p ->"
        " named_struct('at', a.at + char_length(m.gaps) + char_length(m.found), 'out', concat(a.out, array(named_struct("
        "'start', a.at + char_length(m.gaps) + p, 'candidate', substring(m.found, p + 1))))))[0])).out"
    )
    # The outer form, as the plain one is planned with a filter that computes the spans again.
    rows = found.withColumn("s", F.explode_outer(spans)).filter("s IS NOT NULL").select("doc_id", "text_hash", "text", "s.*")
    end = F.col("start") + F.char_length("candidate")
    head = F.greatest(F.col("start") - CONTEXT, F.lit(0))
    return rows.select(
        "doc_id", "text_hash", "start", "candidate",
        F.substring("text", head + 1, F.col("start") - head).alias("before"),
        F.substring("text", end + 1, F.lit(CONTEXT)).alias("after"),
    )


# Dictionary -----------------------------------------------------------------------------
def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n): all lower-case words of all texts."""
    # Different words are few beside all words, so patterns are tried after counting.
    blanks = F.translate(F.lower("text"), "\t\n\x0b\f\r", "     ")
    raw = docs.select(F.explode(F.split(blanks, " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    plain = raw.select(F.regexp_replace("word", "[.,;:!?]+$", "").alias("word"), "n").filter(
        F.length("word").between(3, 20) & F.col("word").rlike("^[a-z]+$")
    )
    return plain.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(counted: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """The words that make at least a share ``least`` of all words."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    return counted.filter(F.col("n") >= total * least)


def transition_costs(words: DataFrame) -> dict[str, float]:
    """Minus the log share of each letter pair among the pairs with its first letter.

    At most 26 * 26 entries.
    """
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2))
    )
    counts = words.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n")).collect()
    firsts: dict[str, int] = {}
    for r in counts:
        firsts[r["pair"][0]] = firsts.get(r["pair"][0], 0) + r["n"]
    return {r["pair"]: -math.log((r["n"] + 1) / (firsts[r["pair"][0]] + 26)) for r in counts}


# Features -------------------------------------------------------------------------------
def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", ""))


def with_features(rows: DataFrame, words: DataFrame, costs: dict[str, float], scratch=None) -> DataFrame:
    """Adds the columns ``FEATURES`` to candidates (candidate, before, after)."""
    c, low = F.col("candidate"), F.lower("candidate")
    n = F.length(c)
    letters = F.split(c, "")
    kinds = F.translate(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9"), "+/_=-", ""
    )
    # One text that folds to an array of 26 * 26 costs: hundreds of literals would fill every plan.
    flat = ",".join(repr(costs.get(a + b, UNSEEN)) for a in ascii_lowercase for b in ascii_lowercase)
    table = F.split(F.lit(flat), ",").cast("array<double>")
    codes = F.transform(F.split(low, ""), lambda x: F.ascii(x) - 97)
    steps = F.zip_with(
        codes, F.slice(codes, 2, n), lambda a, b: F.when(b.isNull(), 0.0)
        .when(a.between(0, 25) & b.between(0, 25), F.get(table, a * 26 + b)).otherwise(UNSEEN),
    )
    cost = F.when(n < 2, UNSEEN).otherwise(F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (n - 1))
    # Written first: row numbers must not change between the two uses.
    keyed = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "candidates", scratch)
    before, around = F.lower("before"), F.lower(F.concat("before", F.lit(" "), "after"))
    flag = lambda condition: condition.cast("double")
    parted = F.lower(F.regexp_replace(c, "(?<=[a-z])(?=[A-Z])", " "))
    runs = keyed.select("_row", F.explode(F.regexp_extract_all(parted, F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = (
        runs.join(words.select("word"), "word").groupBy("_row").agg(F.sum(F.length("word")).alias("_covered"))
    )
    return keyed.join(covered, "_row", "left").withColumns({
        "length": n.cast("double"),
        "digits": _count(c, "0-9") / n,
        "uppers": _count(c, "A-Z") / n,
        "distinct": F.size(F.array_distinct(letters)) / n,
        "switches": F.length(kinds) / n,
        "longest_run": F.coalesce(
            F.array_max(F.transform(F.regexp_extract_all(c, F.lit("((.)\\2*)"), F.lit(1)), lambda r: F.length(r))), F.lit(0)
        ).cast("double"),
        "transitions": cost,
        "coverage": F.coalesce(F.col("_covered"), F.lit(0)) / n,
        "slashes": _count(c, "/").cast("double"),
        "path_before": flag(F.col("before").rlike("[/\\\\.~]$")),
        "secret_words": flag(F.substring(before, -24, 24).rlike(SECRET_WORDS)),
        "other_words": flag(F.substring(before, -24, 24).rlike(OTHER_WORDS)),
        "assigned": flag(F.col("before").rlike("[=:]\\s*[\"'`]?$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        "placeholder": flag(low.rlike(PLACEHOLDERS) | around.rlike("placeholder|dummy") | c.rlike("^[$*{%]")),
        "signs": F.length(F.regexp_replace(c, KEY, "")) / n,
        "known_prefix": flag(c.rlike(f"^{KNOWN}")),
        "user_before": flag(F.col("before").rlike("://[^\\s/:@]*:$") & F.col("after").startswith("@")),
        "word_like": flag(c.rlike("^[A-Z]?[a-z]*$")),
    }).drop("_covered")


# Labelled findings ----------------------------------------------------------------------
def labelled_findings(docs: DataFrame, limit: int = MAX_FINDINGS, scratch=None) -> DataFrame:
    """(candidate, before, after, label): findings of known kind between words of real texts.

    At most ``limit`` texts, those with the smallest hash of doc_id, give ``ROUNDS`` lines with
    a secret and as many with a look-alike. Kinds and values follow from the text's hash. The
    lines are scanned as texts are: a candidate that is not the secret of its line is a
    look-alike, one that only overlaps it is left out.
    """
    h = F.col("h")
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("doc_id").alias("_order"))
    # Hashes alone say where the sample ends; only texts up to there are opened, and words move.
    last = texts.select("_order").orderBy("_order").limit(limit).agg(F.max("_order")).first()[0]
    opened = texts.filter(F.col("_order") <= last if last is not None else F.lit(False)).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("h"), words_of(F.col("text")).alias("w")
    )
    picked = F.array(*[
        F.lower(F.regexp_replace(
            F.coalesce(F.get(F.col("w"), F.pmod(F.xxhash64(h, F.lit(i)), F.greatest(F.size("w"), F.lit(1))).cast("int")), F.lit("a")),
            "[^A-Za-z]", ""))
        for i in range(24)
    ])
    base = take_sample(opened.select("doc_id", "h", picked.alias("w")), "doc_id", limit)
    base = materialize(base.select("h", "w"), "sampled", scratch)
    rounds = F.explode(F.array(*[F.lit(i) for i in range(ROUNDS)])).alias("r")
    base = base.select("h", "w", rounds).select(F.xxhash64("h", "r").alias("h"), "w")
    text = h.cast("string")
    # What values are made of, and then one value of each kind, are written before they are
    # put together: every use would repeat the whole expression in the plan.
    base = materialize(base.select(
        "h", "w", F.sha2(text, 256).alias("hexes"),
        F.translate(F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), text), 256))), "=", "").alias("code"),
        F.concat(F.abs(h % 10**9).cast("string"), F.abs(F.xxhash64(h) % 10**9).cast("string"), F.lit("4071")).alias("digits"),
        F.abs(h % 1000).cast("string").alias("small"), (bucket_of(F.concat(text, F.lit("u")), 6) == 0).alias("upper"),
    ), "parts", scratch)
    hexes, code, digits, small = (F.col(c) for c in ("hexes", "code", "digits", "small"))
    word = lambda i: F.get(F.col("w"), F.lit(i))
    case = lambda text: F.when(F.col("upper"), F.upper(text)).otherwise(text)
    names = F.array(*[F.lit(x) for x in (
        "token = \"", "api_key: ", "password=\"", "secret = '", "Authorization: Bearer ", "access_key=", "token: ", "auth_token = \"",
        "client_secret: \"", "export API_TOKEN=", "AWS_SECRET_ACCESS_KEY=", "https://api.org/v1?access_token=", "\"password\": \"",
        "DB_PASSWORD=", "--password ",
    )])
    bare = F.array(*[F.lit(x) for x in ("", "(", "key ", "id=", "with \"", "use: ")])
    logins = F.array(*[F.lit(x) for x in ("postgres://admin:", "https://me:", "amqp://u:", "ftp://backup:", "redis://:")])
    persons = F.array(*[F.lit(x) for x in ("password=", "password: ", "passwd: ", "pwd=", "DB_PASSWORD=", "password = \"", "\"password\": \"", "--password ")])
    pick = lambda a, i: F.get(a, F.pmod(F.xxhash64(h, F.lit(i)), F.size(a)).cast("int"))
    # Digits as letters: keys without any.
    letters = lambda x: F.translate(x, "0123456789+/", "QzXkVjWpYgab")
    keys = F.array(
        F.substring(code, 1, 40), F.substring(code, 1, 24), letters(F.substring(code, 1, 32)),
        F.concat(F.lit("AKIA"), F.upper(F.substring(hexes, 3, 16))),
        F.concat(F.lit("AKIA"), F.upper(letters(F.substring(code, 3, 16)))),
        F.concat(F.lit("ghp_"), F.translate(F.substring(code, 1, 36), "+/", "ab")),
        F.concat(F.lit("sk-"), F.translate(F.substring(code, 3, 38), "+/", "cd")),
    )
    secrets = F.concat(F.array(F.substring(hexes, 1, 40), F.substring(hexes, 1, 32), hexes), keys)
    passwords = F.array(
        F.concat(F.initcap(word(15)), small, F.lit("!")), F.concat(word(16), F.substring(digits, 1, 1), F.lit("pw")),
        F.concat(F.substring(F.translate(code, "+/", "xy"), 5, 5), F.lit("&"), F.substring(F.translate(code, "+/", "xy"), 11, 5), F.lit("!")),
        F.translate(F.substring(code, 7, 10), "+/", "#$"), F.concat(F.initcap(word(17)), F.lit("-"), word(18), small),
        F.concat(word(19), F.lit("#"), small),
    )
    uuid = F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    other = F.array(
        *[F.struct(F.lit(b).alias("b"), v.alias("v")) for b, v in (
            ("commit ", F.substring(hexes, 2, 40)), ("sha256: ", hexes), ("md5 checksum ", F.substring(hexes, 4, 32)),
            ("uuid=", uuid), ("order ", digits), (" ", digits), ("phone: ", digits),
            ("token = \"", F.concat(F.lit("your_token_"), F.lit("0000"), F.lit("_here"))),
            ("api_key: ", F.concat(F.lit("example-key-"), F.abs(h % 100000).cast("string"))),
            ("password=\"", F.concat(F.lit("xxxxxxxxxxxx"), F.abs(h % 10000).cast("string"))),
            ("path /", F.concat(word(1), F.lit("/"), word(2), F.lit("/"), word(3), F.lit("_v2/index-10"))),
            ("https://www.", F.concat(word(4), F.lit("/"), word(5), F.lit("-"), word(6), F.lit("-2024-11-30-"), word(7))),
            (" ", F.concat(word(8), F.lit("-"), word(9), F.lit("_"), word(10), F.lit("_20240131"))),
            ("build ", F.concat(word(11), F.lit("-20240131-"), F.abs(h % 100000).cast("string"))),
            (" ", F.concat(word(12), word(13), word(14), F.lit("12"))),
            ("image ", F.concat(F.lit("IMG_20240131_"), F.abs(h % 10**6).cast("string"))),
            ("version ", F.concat(F.lit("1-24-3-build-"), F.abs(h % 10**8).cast("string"))),
            ("path=/", F.concat(word(1), F.lit("/"), word(2), F.lit("/"), word(3), F.lit("-2024-10"))),
            ("class ", F.concat(word(1), F.initcap(word(2)), F.initcap(word(3)), F.lit("Factory"))),
            ("", F.concat_ws("-", *[F.initcap(word(i)) for i in (4, 5, 6, 7)])),
            ("author: ", F.initcap(word(8))), ("token: ", word(9)), ("password: ", word(10)), ("auth_method=", word(11)),
            ("secret: \"", F.concat_ws(" ", word(12), word(13), word(14))), ("max_tokens=", small), ("token_count: ", small),
            ("password=", F.lit("${DB_PASSWORD}")), ("password: ", F.lit("********")), ("password = ", F.lit("None")),
            ("mailto:", F.concat(word(15), F.lit("@example.org"))), ("private: ", word(16)),
            ("path ", F.concat(F.lit("/srv/"), word(17), F.lit("/Data/"), word(18), F.lit("/"), F.initcap(word(19)))),
        )]
    )
    base = materialize(base.select(
        "upper", F.concat(word(20), F.lit(" "), word(21), F.lit(" ")).alias("left"),
        F.concat(F.lit(" "), word(22), F.lit(" "), word(23)).alias("right"),
        pick(names, 31).alias("name"), pick(bare, 31).alias("bare"), pick(logins, 31).alias("login"),
        pick(persons, 31).alias("person"), pick(secrets, 33).alias("secret"), pick(keys, 33).alias("key"),
        pick(passwords, 33).alias("password"), F.concat(word(16), small, F.lit("pw")).alias("simple"),
        pick(other, 32).alias("fake"), F.pmod(F.xxhash64(h, F.lit(34)), F.lit(8)).alias("kind"),
    ), "values", scratch)
    left, right, kind = F.col("left"), F.col("right"), F.col("kind")
    quote = lambda b: F.when(b.endswith('"'), '"').when(b.endswith("'"), "'").otherwise("")
    spot = lambda b, v, end=None: F.struct(b.alias("b"), v.alias("v"), (quote(b) if end is None else end).alias("end"))
    true = (
        F.when(kind == 0, spot(F.col("login"), F.col("simple"), F.lit("@db.org/x")))
        .when(kind == 1, spot(F.col("login"), F.col("password"), F.lit("@db.org/x")))
        .when(kind == 2, spot(F.col("bare"), F.col("key")))
        .when(kind <= 4, spot(F.col("person"), F.col("password")))
        .otherwise(spot(F.col("name"), F.col("secret")))
    )

    def lines(it: Column, label: float) -> DataFrame:
        rows = base.select(case(F.concat(left, it["b"])).alias("b"), case(it["v"]).alias("v"), F.concat(it["end"], right).alias("end"))
        planted = F.struct(F.lit(label).alias("label"), F.char_length("b").alias("at"), F.col("v"))
        return rows.select(planted.alias("doc_id"), F.concat("b", "v", "end").alias("text"))

    planted = lines(true, 1.0).unionByName(lines(spot(F.col("fake.b"), F.col("fake.v")), 0.0))
    found = candidates(materialize(planted, "lines", scratch))
    at, value = F.col("doc_id.at"), F.col("doc_id.v")
    whole = (F.col("start") == at) & (F.col("candidate") == value)
    apart = (F.col("start") >= at + F.char_length(value)) | (F.col("start") + F.char_length("candidate") <= at)
    label = F.when(whole, F.col("doc_id.label")).when(apart | (F.col("doc_id.label") == 0), 0.0)
    return found.select("candidate", "before", "after", label.alias("label")).filter(F.col("label").isNotNull())


# Forest ---------------------------------------------------------------------------------
_ASSEMBLER = dict(inputCols=list(FEATURES), outputCol="_features")


class Scanner:
    """Dictionary, letter pairs and forest, fitted on one corpus."""

    def __init__(self, words: DataFrame, costs: dict[str, float], forest: RandomForestClassificationModel | None) -> None:
        self.words, self.costs, self.forest = words, costs, forest

    def findings(self, docs: DataFrame, scratch=None) -> DataFrame:
        """Candidates of ``docs`` with ``score`` and ``is_secret``; without a forest (no text
        to learn from) every score is 0."""
        rows = with_features(candidates(docs), self.words, self.costs, scratch)
        return self._scored(rows).select(
            "doc_id", "text_hash", "start", F.char_length("candidate").alias("length"),
            F.sha2("candidate", 256).alias("candidate_sha256"), "score", (F.col("score") >= 0.5).alias("is_secret"),
        )

    def _scored(self, rows: DataFrame) -> DataFrame:
        if self.forest is None:
            return rows.withColumn("score", F.lit(0.0))
        voted = self.forest.transform(VectorAssembler(**_ASSEMBLER).transform(rows))
        return voted.withColumn("score", vector_to_array("_p")[1])


def train(docs: DataFrame, limit: int = MAX_FINDINGS, scratch=None, seed: int = 17) -> Scanner:
    """Fit on all texts (dictionary) and on bounded labelled findings (forest)."""
    counted = materialize(counted_words(docs), "words", scratch)
    costs = transition_costs(counted)
    words = dictionary(counted)
    rows = with_features(labelled_findings(docs, limit, scratch), words, costs, scratch)
    rows = materialize(rows.select("label", *FEATURES), "findings", scratch)
    if rows.select("label").distinct().count() < 2:
        return Scanner(words, costs, None)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_y",
        numTrees=TREES, maxDepth=DEPTH, seed=seed,
    )
    ordered = rows.coalesce(1).sortWithinPartitions("label", *FEATURES)  # a few per labelled line
    return Scanner(words, costs, forest.fit(VectorAssembler(**_ASSEMBLER).transform(ordered)))


def redact(docs: DataFrame, scanner: Scanner, scratch=None) -> DataFrame:
    """``docs`` with every accepted finding in ``text`` replaced by a mask; ``n_chars``, if
    there is such a column, follows. Rows without a candidate do not take part in the join."""
    secrets = scanner.findings(docs, scratch).filter("is_secret").select("doc_id", "text_hash", "start", "length").distinct()
    spans = secrets.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length")), asc=False).alias("_spans")  # of one text
    )
    spans = materialize(spans, "spans", scratch)
    some = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    # The row travels as one value, so no name of its columns can clash.
    hashed = docs.filter(some).select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("_h"))
    same = F.col("row.doc_id").eqNullSafe(spans["_d"]) & (hashed["_h"] == spans["_t"])
    masked = F.aggregate(
        F.col("_spans"), F.col("row.text"),
        lambda t, s: F.concat(
            F.substring(t, F.lit(1), s["start"]), F.lit(MASK),
            F.substring(t, s["start"] + s["length"] + 1, F.char_length(t)),
        ),
    )
    joined = hashed.join(spans, same, "left").withColumn("_text", F.coalesce(masked, F.col("row.text")))
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        count = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("_spans").isNull(), F.col("row.n_chars")).otherwise(count)
    return joined.select(*[x.alias(c) for c, x in columns.items()]).unionByName(docs.filter(~some))
