"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Four base kinds are found by pattern and check digits. Beyond them, broad patterns
propose candidate spans; labelers (patterns, word lists, words before and after) vote for
or against each or abstain. Expectation-maximisation on the counts of vote patterns
estimates how reliable each labeler is for each kind and so how likely each pattern
is private data. With these likelihoods as soft labels a logistic classifier is fitted
on features of the spans, which also covers spans on which most labelers abstain.

Everything on the corpus is DataFrame functions. What reaches the driver are counts of
vote patterns and of feature combinations, whose number is fixed by the lists below
and not by the corpus.
"""

from __future__ import annotations

from math import exp, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.store import stored

BASE_KINDS = ("email", "ip", "card", "phone")

# Runs are taken whole (a match begins where the one before ended or where a run begins), so
# no pattern tries a run again from each of its characters; what they match is what the plain
# patterns match from left to right.
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# A text without this sign or class has no match.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Given names as a gazetteer, in the languages of the corpus.
GIVEN_NAMES = (
    "adam alice anna anne antonio carlos carmen charles claire david elena emma eva "
    "francisco franz hans helena henri isabel jack jacques james jan jean jennifer john "
    "jose juan julia karl klaus laura louis lucas lucia luis manuel maria marie mark "
    "martin mary max michael miguel nicolas olivia oscar patricia paul pedro peter "
    "philippe pierre robert sarah sofia sophie susan thomas ursula william wolfgang"
).split()

# Capitalised words that are no names.
NOT_NAMES = (
    "the general public license apache software foundation free gnu mit version copyright "
    "january february march april june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday north south east west new united"
)

# Words that announce private data of a kind, and words that announce something else.
ANNOUNCE = {
    "secret": "token key secret password passwd pwd apikey api_key bearer auth credential clave passwort",
    "number": (
        "ssn passport iban account konto cuenta compte tel telephone phone telefon mobile call fax "
        "card visa id licence dni nif social security number"
    ),
    "name": "mr mrs ms dr herr frau monsieur madame mme senor senora name contact author patient",
}
REFUTE = {
    "secret": "sha sha1 sha256 md5 commit digest checksum revision",
    "number": "version page chapter section figure table year isbn license copyright art no vol",
    "name": "street avenue saint university river mount license public",
}

CANDIDATES = {
    # 16 or more letters and digits in one run, both of them present.
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+",
    # Groups of digits joined by single signs, at least seven digits long in all.
    "number": r"(?<![A-Za-z0-9.])[A-Z]{0,2}[0-9](?:[\x20.()/-]{0,2}[0-9]){6,}+",
    # Two or three capitalised words in a row.
    "name": r"(?<![\p{L}])\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++){1,2}+(?![\p{L}])",
}

KINDS = tuple(CANDIDATES)
LABELERS = ("shape", "listed", "announced", "refuted", "after", "marked")

# Features of the classifier beside the kind; each has few values.
FEATURES = ("length", "digits", "capitals", "form", "context", "follows")

# Code points before a span in which its words of context lie, and how many of these words count.
CONTEXT, CONTEXT_WORDS = 40, 3

# Matches whose lengths are summed at once.
CHUNK = 64

# What a labeler's votes are taken to say before any count: P(vote | private), P(vote | not).
GUESS = ({1: 0.6, 0: 0.3, -1: 0.1}, {1: 0.1, 0: 0.4, -1: 0.5})
GUESS_WEIGHT = 20.0


class Model(NamedTuple):
    """What was learned: share of private candidates, reliabilities, weights of the classifier."""

    prior: dict[str, float]
    reliability: dict[tuple[str, str], tuple[dict[int, float], dict[int, float]]]
    weights: dict[str, float]


# ------------------------------------------------------------ where patterns match


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often, and in whatever lambda, it is read."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _spans(text: Column, pattern: str, sign: str | None = None) -> Column:
    """Array of (start, end, span, before, after) of all matches; ``sign`` is in every match.

    Starts are running sums of the lengths of matches and of what lies between them, taken
    in chunks, so a text of very many matches does not cost the square of their number.
    """

    def located(matches: Column, gaps: Column) -> Column:
        lengths = F.zip_with(matches, gaps, lambda m, g: F.coalesce(F.char_length(m), F.lit(0)) + F.char_length(g))
        return _let(lengths, lambda each: with_lengths(matches, gaps, each))

    def with_lengths(matches: Column, gaps: Column, each: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(each) / CHUNK).cast("int"))
        sums = F.transform(chunks, lambda j: _total(F.slice(each, j * CHUNK + 1, F.lit(CHUNK))))
        return _let(sums, lambda s: with_sums(matches, gaps, each, s))

    def with_sums(matches: Column, gaps: Column, each: Column, sums: Column) -> Column:
        starts = F.transform(sums, lambda _, j: _total(F.slice(sums, F.lit(1), j)))
        return _let(starts, lambda b: with_starts(matches, gaps, each, b))

    def with_starts(matches: Column, gaps: Column, each: Column, chunk_start: Column) -> Column:
        def span(match: Column, i: Column) -> Column:
            within = _total(F.slice(each, i - i % CHUNK + 1, i % CHUNK))
            start = F.get(chunk_start, F.floor(i / CHUNK).cast("int")) + within + F.char_length(F.get(gaps, i))
            return F.struct(
                start.alias("start"),
                (start + F.char_length(match)).alias("end"),
                match.alias("span"),
                F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
            )

        return F.transform(matches, span)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if sign:
        found = F.when(F.contains(text, F.lit(sign)), found).otherwise(F.array().cast("array<string>"))
    return _let(found, lambda m: _let(F.split(text, pattern, -1), lambda g: located(m, g)))


def _masked(text: Column, kind: str) -> Column:
    """The text with all spans of a base kind blanked, at its old length."""
    pattern = BASE_PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def blank(gap: Column, match: Column) -> Column:
        # A control sign that no pattern and no word of context has.
        filled = F.repeat(F.lit("\x01"), F.char_length(match))
        return F.concat(gap, F.when(match.isNull(), "").when(_valid(match, kind), filled).otherwise(match))

    masked = F.array_join(F.zip_with(F.split(text, pattern, -1), matches, blank), "")
    return F.when(F.col(f"n_{kind}") > 0, masked).otherwise(text)


def _valid(span: Column, kind: str) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(span, "[.]"), lambda part: F.coalesce(part.try_cast("int"), F.lit(256)) <= 255)
    digits = F.regexp_replace(span, "[^0-9]", "")
    if kind == "phone":
        return F.char_length(digits).between(9, 15)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    luhn = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add)
    return F.when(F.char_length(digits).between(12, 19), luhn % 10 == 0).otherwise(False)


# ------------------------------------------------------------ candidates, votes, features


def _any_word(words: Column, listed: str) -> Column:
    return F.arrays_overlap(words, F.array(*(F.lit(w) for w in listed.split())))


def _vote(plus: Column, minus: Column) -> Column:
    return F.when(plus, 1).when(minus, -1).otherwise(0)


def _judged(kind: str):
    """A function from a span to its votes and features."""

    def judged(s: Column) -> Column:
        span, after = s["span"], F.coalesce(s["after"], F.lit(""))
        length, digits = F.char_length(span), F.regexp_replace(span, "[^0-9]", "")
        n_digits, n_capitals = F.char_length(digits), F.char_length(F.regexp_replace(span, "[^\\p{Lu}]", ""))
        context = F.regexp_extract_all(F.lower(s["before"]), F.lit("[\\p{L}0-9_]+"), F.lit(0))
        context = F.slice(context, F.greatest(F.size(context) - CONTEXT_WORDS + 1, F.lit(1)), CONTEXT_WORDS)
        announced, refuted = _any_word(context, ANNOUNCE[kind]), _any_word(context, REFUTE[kind])
        mark = F.right(F.rtrim(s["before"]), F.lit(1))
        marked = mark.isin(":", "=", '"', "'", "#", "(")
        never = F.lit(False)
        if kind == "secret":
            form = F.when(span.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), "hex")
            form = form.when(span.rlike("[A-Z]") & span.rlike("[a-z]") & (n_digits > 2), "mixed").otherwise("other")
            shape = _vote(form.isin("hex", "mixed"), (n_digits < 3) | span.rlike("[a-z]-[a-z]"))
            listed = _vote(span.rlike("^(?:sk|pk|gh[opsu]|xox[abp]|AKIA|AIza|eyJ)"), span.rlike("^[0-9]{4}-[0-9]{2}"))
        elif kind == "number":
            form = F.when(span.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "groups")
            form = form.when(span.rlike("^[A-Z]{2}[0-9]{2}"), "country")
            form = form.when(span.rlike("^[0-9]{3}[ .)-]{1,2}[0-9]{3}[ .-][0-9]{4}$"), "local")
            form = form.when(span.rlike("^(?:19|20)[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{2}"), "date")
            form = form.when(span.rlike("^[0-9]+$"), "run").otherwise("other")
            shape = _vote(form.isin("groups", "country", "local"), form.isin("date", "run") | (n_digits > 30))
            codes = "^(?:AD|AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)[0-9]{2}|^0049|^0033|^0034|^0044"
            listed = _vote(span.rlike(codes), span.rlike("^(.)\\1+$"))
        else:
            parts = F.split(F.lower(span), " ")
            names = F.array(*(F.lit(n) for n in GIVEN_NAMES))
            known, repeated = F.arrays_overlap(parts, names), F.size(F.array_distinct(parts)) < F.size(parts)
            form = F.when(repeated, "repeated").when(known, "known").when(F.size(parts) == 2, "two").otherwise("three")
            shape = _vote(never, repeated)
            listed = _vote(known, _any_word(parts, NOT_NAMES))
        follows = F.when(after == "", "end").when(after.rlike("[\\p{L}0-9_%$]"), "word").otherwise("sign")
        votes = (
            shape,
            listed,
            _vote(announced, never),
            _vote(never, refuted),
            _vote(after.isin('"', "'", ";", ")"), follows == "word"),
            _vote(marked, F.trim(s["before"]) == ""),
        )
        values = (
            F.least(F.floor(F.log2(length)), F.lit(7)).cast("string"),
            F.floor(4 * n_digits / length).cast("string"),
            F.least(F.floor(4 * n_capitals / length), F.lit(2)).cast("string"),
            form,
            F.when(announced, "announced").when(refuted, "refuted").when(marked, "marked").otherwise("none"),
            follows,
        )
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.struct(*(v.alias(n) for v, n in zip(votes, LABELERS))).alias("votes"),
            F.struct(*(v.alias(n) for v, n in zip(values, FEATURES))).alias("features"),
        )

    return judged


def find(docs: DataFrame) -> DataFrame:
    """Base spans and judged candidates of every row: doc_id, n_<kind>, base, candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def kept(order: int, kind: str) -> Column:
        spans = F.filter(_spans(F.col("text"), BASE_PATTERNS[kind], NEEDED[kind]), lambda s: _valid(s["span"], kind))
        return F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")),
        )

    df = df.select("doc_id", "text", *(kept(i, k).alias(k) for i, k in enumerate(BASE_KINDS)))
    counts = (F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS)
    df = df.select("doc_id", "text", *counts, F.sort_array(F.concat(*BASE_KINDS)).alias("base"))
    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base"]
    for kind in BASE_KINDS:
        df = df.select(*names, _masked(F.col("text"), kind).alias("text"))
    judged = (F.transform(_spans(F.col("text"), p), _judged(k)) for k, p in CANDIDATES.items())
    return df.select(*names, F.concat(*judged).alias("candidates"))


# ------------------------------------------------------------ what the votes say


def reliabilities(patterns: dict[tuple, int], rounds: int = 60) -> tuple[float, list, dict[tuple, float]]:
    """EM on counts of vote patterns of one kind: prior, reliabilities, posterior of each pattern.

    A labeler's vote is independent of the others' given the truth. The guess counts as
    a few votes, so that few candidates, or none, leave it as it is and the two
    classes keep their meaning.
    """
    width = len(LABELERS)
    prior, tables = 0.3, [GUESS] * width
    posterior: dict[tuple, float] = {}
    for _ in range(rounds):
        for votes in patterns:
            odds = log(prior / (1 - prior))
            odds += sum(log(t[0][v] / t[1][v]) for t, v in zip(tables, votes))
            posterior[votes] = 1 / (1 + exp(-odds)) if odds > -700 else 0.0
        yes = sum(n * posterior[v] for v, n in patterns.items())
        total = sum(patterns.values())
        prior = (yes + 0.3 * GUESS_WEIGHT) / (total + GUESS_WEIGHT)
        tables = [
            tuple(
                {
                    vote: (sum(n * weigh(posterior[v]) for v, n in patterns.items() if v[j] == vote) + GUESS_WEIGHT * guess[vote])
                    / (mass + GUESS_WEIGHT)
                    for vote in (1, 0, -1)
                }
                for guess, mass, weigh in ((GUESS[0], yes, lambda p: p), (GUESS[1], total - yes, lambda p: 1 - p))
            )
            for j in range(width)
        ]
    return prior, tables, posterior


def classifier(rows: list[tuple[tuple[str, ...], float, float]], rounds: int = 300, ridge: float = 1.0) -> dict[str, float]:
    """Logistic weights per feature from (features, rows, rows that are private) of each combination."""
    weights: dict[str, float] = {}
    curve: dict[str, float] = {}
    for names, n, _ in rows:
        for name in names:
            weights[name] = 0.0
            curve[name] = curve.get(name, 0.0) + n / 4
    for _ in range(rounds):
        slope = {name: -ridge * w for name, w in weights.items()}
        for names, n, yes in rows:
            miss = yes - n / (1 + exp(-max(-700.0, sum(weights[x] for x in names))))
            for name in names:
                slope[name] += miss
        # Every row has as many features as it has terms, so this step never overshoots.
        size = len(rows[0][0]) if rows else 1
        for name in weights:
            weights[name] += slope[name] / (size * curve[name] + ridge)
    return weights


def _feature_names(kind: str, features) -> tuple[str, ...]:
    return (kind, *(f"{kind}|{name}={value}" for name, value in zip(FEATURES, features)))


def learn(found: DataFrame) -> Model:
    """Reliabilities and classifier from all candidates of :func:`find`.

    To the driver come at most 3 x 3**6 vote patterns with their counts, and a row per
    combination of features, of which there are at most 3 x 8 x 5 x 3 x 6 x 4 x 3.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features")
    counts = each.groupBy("kind", "votes", "features").agg(F.count("*").alias("n"))
    counts = stored(counts, "span-patterns")
    patterns: dict[str, dict[tuple, int]] = {kind: {} for kind in KINDS}
    for r in counts.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect():
        patterns[r["kind"]][tuple(r["votes"])] = r["n"]
    prior, reliability, posteriors = {}, {}, []
    for kind in KINDS:
        prior[kind], tables, posterior = reliabilities(dict(sorted(patterns[kind].items())))
        reliability |= {(kind, name): table for name, table in zip(LABELERS, tables)}
        posteriors += [(kind, votes, p) for votes, p in posterior.items()]
    ddl = f"kind string, votes struct<{', '.join(f'{n}: int' for n in LABELERS)}>, p double"
    soft = found.sparkSession.createDataFrame(posteriors, ddl)
    rows = counts.join(F.broadcast(soft), ["kind", "votes"]).groupBy("kind", "features")
    rows = rows.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("yes")).collect()
    rows = sorted((_feature_names(r["kind"], r["features"]), float(r["n"]), r["yes"]) for r in rows)
    return Model(prior, reliability, classifier(rows))


def likelihood(candidate: Column, model: Model) -> Column:
    """Probability that a candidate is private; weights are to nine digits, so sums do not hang on their order."""
    if not model.weights:
        return F.lit(0.0)
    weights = F.create_map(*(F.lit(x) for name, w in model.weights.items() for x in (name, round(w, 9))))
    kind = candidate["kind"]
    names = [kind, *(F.concat(kind, F.lit(f"|{n}="), candidate["features"][n]) for n in FEATURES)]
    total = sum((F.coalesce(F.try_element_at(weights, n), F.lit(0.0)) for n in names), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Private spans of every row of ``docs``.

    Null texts are empty; rows are judged one by one, so repeated and null ids do not matter,
    and an empty table gives no rows. A base match that fails its check is dropped
    without another try. An added span never overlaps a base one: base spans are
    blanked before candidates are looked for. A document without spans has the digest of
    the empty text and empty ``spans``.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.
    """
    found = stored(find(docs), "private-spans")
    model = learn(found)
    added = F.filter("candidates", lambda c: likelihood(c, model) >= threshold)
    added = F.transform(
        added,
        lambda c: F.struct(
            c["start"].alias("start"),
            (len(BASE_KINDS) + F.array_position(F.array(*(F.lit(k) for k in KINDS)), c["kind"])).cast("int").alias("order"),
            c["end"].alias("end"),
            c["kind"].alias("kind"),
        ),
    )
    return found.select("*", added.alias("added")).select(
        "doc_id",
        *(f"n_{k}" for k in BASE_KINDS),
        F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _text(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
