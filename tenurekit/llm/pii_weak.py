r"""Personal data by weak supervision, in native Spark expressions only.

Base kinds (email, ip, card, phone) come from fixed patterns with their own
validity rules; these spans always stay.  Beyond them, tokens that look like
credentials are candidates of kind ``secret``, and so is, whatever its
characters, the value after a cue word and an assignment (four characters or
more; spaces only in quotes), after ``Bearer`` or after the name of a personal
number.  Labelers of three sorts vote
on each candidate: patterns (shape, length, mix of letters and digits), a
gazetteer of cue words, and context (assignment, quotes).  Spark counts the
vote patterns of all candidates; expectation-maximisation over that table
(at most a few thousand rows, whatever the corpus) estimates how reliable each
labeler is, and its posteriors train a logistic span classifier, which is
applied to the candidates as one column expression.

Positions are found without user functions: the text is split at the matches,
and prefix sums over the lengths of what lies between give code-point starts.
Prefix sums run in blocks, so a text with very many matches stays near linear.
Patterns use possessive quantifiers and enter a run of word characters only at
its start (or where the last match ended), so no text takes quadratic time.

Defined results: null counts as the empty text and has no spans; without
candidates the classifier keeps its prior weights; repeated rows get equal
results; ``redact`` keeps all columns, whatever their names, leaves null texts
null, merges overlapping spans and names the first one's kind.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let, stored

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # tokens of eight characters or more that hold a digit or an equals sign
    "secret": r"(?:\G|(?<!\S))(?=\S{8})[^\s0-9=]*+[0-9=]\S*+",
}
#: what a text must hold for the pattern to be tried at all
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[0-9=]"}

#: gazetteers (parameters)
CUES = ("password passwd passphrase pwd token secret apikey api_key api-key access_key accesskey private_key privatekey credential bearer "
        "passwort kennwort geheim contraseña clave motdepasse auth").split()
#: how keys of well-known services begin
KEY_PREFIXES = r"(?:AKIA|ASIA)[0-9A-Z]{12}|ghp_|gho_|github_pat_|xox[abp]-|sk_live_|sk-|AIza|glpat-|eyJ"
#: cue words that hardly occur before a colon otherwise
STRONG_CUES = ("password passwd passphrase pwd apikey api_key api-key access_key accesskey private_key privatekey "
               "passwort kennwort contraseña motdepasse").split()
#: names of personal numbers
ID_CUES = (r"ssn|social[\x20-]security(?:[\x20-](?:number|no\.?))?|national[\x20-]id|tax[\x20-]?id|passport(?:[\x20](?:number|no\.?))|account[\x20](?:number|no\.?)|"
           r"steuer-?(?:id|nummer)|sozialversicherungsnummer|ausweisnummer|kontonummer|dni|nif")
#: what follows a cue word in forms and manuals
PLACEHOLDERS = "required optional forgot forgotten remember none null empty hidden reset change changed invalid incorrect wrong must".split()
BENIGN = "version license licence lizenz licencia page chapter isbn doi vol http www figure table".split()

_ASSIGNED = r"[\"']?[\x20\t]{0,3}(?::=|=>|[:=])[\x20\t]{0,3}(?:bearer[\x20])?"
_ID_PREFIX = rf"(?:{ID_CUES})[\x20\t]{{0,3}}[:=#]?[\x20\t]{{0,3}}"
_ID = r"(?=[0-9])[0-9](?:[./-]?[0-9]){5,31}+[A-Za-z]?"


def _assigned(cues: list[str]) -> str:
    return rf"(?:{'|'.join(sorted(cues, key=len, reverse=True))}){_ASSIGNED}"


_QUOTED = r"\"[^\"\n]{4,}+\"|'[^'\n]{4,}+'"
PATTERNS["cued"] = rf"(?iu)(?<!\p{{L}})(?:{_assigned(CUES)}(?:{_QUOTED}|\S{{4,}}+)|bearer[\x20][\w.~+/=-]{{8,}}+|{_ID_PREFIX}{_ID})"
#: one of these is in every match of it, in lower case
_CUED_STEMS = [*CUES, *("ssn|social security|social-security|national id|national-id|tax id|tax-id|taxid|passport n|account n|steuerid|steuer-id|"
                        "steuernummer|steuer-nummer|sozialversicherungsnummer|ausweisnummer|kontonummer|dni|nif").split("|")]
#: the part of a match before the value
_CUE_PREFIX = rf"(?iu)^(?:{_assigned(CUES)}|bearer[\x20]|{_ID_PREFIX})"

MIN_PROBABILITY = 0.9
MAX_STEPS = 200
#: what all candidates weigh together, at most, against the start of the classifier
MAX_EVIDENCE = 1000.0


def _prefix(values: Column, first: Column, join) -> Column:
    """Running results before each value: [first, first + v0, ...] for a sum."""
    return F.aggregate(
        values, F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, x: F.struct(join(a["at"], x).alias("at"), F.array_append(a["all"], a["at"]).alias("all")), lambda a: a["all"])


def _before(values: Column, join=lambda a, x: a + x, block: int = 128) -> Column:
    """Exclusive running sums (or maxima, with ``join``) of non-negative ints, in blocks."""
    total = lambda x: F.aggregate(x, F.lit(0), join)
    n_blocks = F.ceil(F.size(values) / block).cast("int")
    blocks = F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))), lambda k: F.slice(values, k * block + 1, block)))
    blocks = F.coalesce(blocks, F.array().cast("array<array<int>>"))
    return let(blocks, lambda b: F.flatten(F.zip_with(b, _prefix(F.transform(b, total), F.lit(0), join), lambda x, first: _prefix(x, first, join))))


def _gate(text: Column, kind: str) -> Column:
    """Whether the kind's pattern is to be tried on the text."""
    if kind != "cued":
        return F.rlike(text, F.lit(GATES[kind]))
    return let(F.lower(text), lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in _CUED_STEMS]))


_NONE = "array<struct<s: int, e: int, m: string, c: string>>"


def matches(text: Column, kind: str) -> Column:
    """Matches as structs: start, end (code points, end exclusive), the matched
    text and what stands before it (up to 32 characters, after the last match)."""
    pattern = PATTERNS[kind]

    def located(x: Column) -> Column:
        between, found = x["between"], x["found"]
        lengths = F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m))

        def build(starts: Column) -> Column:
            return F.transform(found, lambda m, i: let(
                F.get(starts, i) + F.length(F.get(between, i)),
                lambda s: F.struct(s.alias("s"), (s + F.length(m)).alias("e"), m.alias("m"), F.right(F.get(between, i), F.lit(32)).alias("c"))))
        return let(let(lengths, lambda x: _before(x)), build)

    parts = F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return F.when(_gate(text, kind), let(parts, located)).otherwise(F.array().cast(_NONE))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    def value(i):  # i-th from the right, from 1
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1))
        return F.when(i % 2 == 0, F.translate(d, "0123456789", "0246813579")).otherwise(d).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        def small(p):  # at most 255, with any number of leading zeros
            x = F.ltrim(p, F.lit("0"))
            return (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a base kind; matches that fail are dropped, not retried."""
    found = matches(text, kind)
    return found if kind == "email" else F.filter(found, lambda x: _valid(kind, x["m"]))


# ---- candidates and votes ------------------------------------------------

LABELERS = ("shape", "gazetteer", "context", "mixture", "length")


def _votes(c: Column) -> dict[str, Column]:
    """1: personal, -1: not, 0: no opinion."""
    m, before = c["m"], F.lower(c["c"])
    said = F.concat(before, F.lit(" "), F.lower(m))
    # cue words within the last part of the context or in the token itself
    cue = "|".join(x.replace(".", r"\.") for x in CUES)
    letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    digits = F.length(_digits(m))
    # the candidate is the value after a cue
    raw, value = F.concat(c["c"], m), rf"(?:{_QUOTED}|\S+)$"
    follows = lambda prefix: F.rlike(raw, F.lit(rf"(?iu)(?<!\p{{L}})(?:{prefix}){value}"))
    strong = follows(_assigned(STRONG_CUES)) | F.rlike(raw, F.lit(rf"(?iu)(?<!\p{{L}}){_ID_PREFIX}{_ID}\p{{Punct}}*$"))
    given = follows(_assigned(CUES))
    bearer = F.rlike(raw, F.lit(r"(?<!\p{L})(?:Bearer|BEARER)\x20[\w.~+/=-]{12,}$"))
    # short words after a cue that prose uses too are judged by their looks
    cued = strong | ((given | follows(r"bearer\x20")) & ((c["e"] - c["s"] >= 8) | (digits > 0)))
    against = F.when(cued, 0).otherwise(-1)  # what a value after a cue looks like says nothing against it
    empty = F.rlike(F.lower(m), F.lit(rf"(?:^|[:=])[\"'(\[<]*(?:{'|'.join(PLACEHOLDERS)})[\"')\]>.,;:!?]*$"))
    return {
        "shape": F.when(empty, -1).when(cued, 1).when(F.rlike(m, F.lit(r"(?:AKIA|ASIA)[0-9A-Z]{16}|(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{16,}|(?:sk|pk|ghp|xox[a-z])[-_][0-9A-Za-z-]{16,}")), 1)
                  .when(F.rlike(m, F.lit(r"^[^0-9A-Za-z]*[0-9]+(?:[.,:/-][0-9]+)*[^0-9A-Za-z]*$")), -1).otherwise(0),
        "gazetteer": F.when(empty, -1).when(cued, 1).when(F.rlike(said, F.lit(rf"(?<![a-z])(?:{cue})(?![a-z])[^a-z]{{0,12}}\S*$")) | F.rlike(m, F.lit(rf"^[\"'(\[<]*(?:{KEY_PREFIXES})")), 1)
                      .when(F.rlike(said, F.lit("|".join(BENIGN))), -1).otherwise(0),
        "context": F.when(cued & (strong | given | bearer), 1).when(F.rlike(F.concat(c["c"], m), F.lit(r"[A-Za-z_][\x20]?=[\x20]?[\"']?[0-9A-Za-z/+_-]{8,}|:[\x20]?[\"'][0-9A-Za-z/+_-]{8,}[\"']")), 1)
                    .when(F.rlike(m, F.lit(r"^[\"'(]*[a-z]+://")), -1).otherwise(0),
        "mixture": F.when((letters >= 4) & (digits >= 3), 1).when((letters == 0) | (digits == 0), against).otherwise(0),
        "length": F.when(F.length(m) >= 16, 1).when(F.length(m) < 12, against).otherwise(0),
    }


def _trimmed(c: Column) -> Column:
    """The candidate without quotes and punctuation around it."""
    m = c["m"]
    left = F.length(m) - F.length(F.regexp_replace(m, r"^[\"'(\[<]+", ""))
    inner = F.regexp_replace(m, r"^[\"'(\[<]+|[\"')\]>.,;:!?]+$", "")
    return F.struct((c["s"] + left).alias("s"), (c["s"] + left + F.length(inner)).alias("e"), c["m"].alias("m"), c["c"].alias("c"))


def _value(c: Column) -> Column:
    """The value of a match that begins with its cue."""
    def cut(prefix):
        n = F.length(prefix)
        return F.struct((c["s"] + n).alias("s"), c["e"].alias("e"), F.substring(c["m"], n + 1, F.length(c["m"])).alias("m"),
                        F.right(F.concat(c["c"], prefix), F.lit(32)).alias("c"))
    return let(F.regexp_extract(c["m"], _CUE_PREFIX, 0), cut)


def candidates(text: Column, base: Column) -> Column:
    """Candidate secrets that do not touch a base span: tokens by their looks,
    and values after a cue that are not among them."""
    apart = lambda c, spans: ~F.exists(spans, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
    found = F.filter(F.transform(matches(text, "secret"), _trimmed), lambda c: (c["e"] - c["s"] >= 8) & apart(c, base))
    cued = F.filter(F.transform(F.transform(matches(text, "cued"), _value), _trimmed),
                    lambda c: (c["e"] - c["s"] >= 4) & F.rlike(c["m"], F.lit(r"[\p{L}\p{N}]")) & apart(c, base))
    return let(found, lambda f: F.array_sort(F.concat(f, F.filter(cued, lambda c: apart(c, f)))))


def _buckets(c: Column) -> dict[str, Column]:
    """Discrete features of the span beside the votes."""
    n = c["e"] - c["s"]
    return {"size": F.when(n < 12, 0).when(n < 20, 1).when(n < 48, 2).otherwise(3),
            "upper": F.rlike(c["m"], F.lit("[A-Z]")).cast("int"), "lower": F.rlike(c["m"], F.lit("[a-z]")).cast("int")}


FEATURES = (*LABELERS, "size", "upper", "lower")


def _described(c: Column) -> Column:
    return F.struct(*[v.cast("int").alias(k) for k, v in {**_votes(c), **_buckets(c)}.items()])


def vote_table(docs: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """(features of a candidate, number of candidates), at most 3^5 * 16 rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.select(text.alias("text")).filter(_gate(F.col("text"), "secret") | _gate(F.col("text"), "cued"))
    base = F.concat(*[base_spans(F.col("text"), k) for k in BASE_KINDS])
    c = some.select("text", base.alias("base")).select(F.explode(candidates(F.col("text"), F.col("base"))).alias("c"))
    rows = c.select(_described(F.col("c")).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((tuple(r.f), r.n) for r in rows)


def estimate(table: list[tuple[tuple[int, ...], int]], steps: int = MAX_STEPS, tolerance: float = 1e-7):
    """EM over vote patterns: P(personal), and for each labeler the chances of
    its votes (-1, 0, 1) given not personal and personal."""
    k = len(LABELERS)
    # a mild prior: labelers are somewhat better than chance
    prior = [[{-1: 2.0, 0: 2.0, 1: 1.0}, {-1: 1.0, 0: 2.0, 1: 2.0}] for _ in range(k)]
    rate, chances = 0.5, [[{v: p / 5 for v, p in side.items()} for side in lab] for lab in prior]

    def posterior(votes):
        odds = math.log(rate / (1 - rate)) + sum(math.log(chances[j][1][votes[j]] / chances[j][0][votes[j]]) for j in range(k))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))

    for _ in range(steps):
        weight, soft = [1.0, 1.0], [[dict(side) for side in lab] for lab in prior]
        for f, n in table:
            p = posterior(f)
            for y, q in ((0, 1 - p), (1, p)):
                weight[y] += n * q
                for j in range(k):
                    soft[j][y][f[j]] += n * q
        new = weight[1] / sum(weight)
        chances = [[{v: x / sum(side.values()) for v, x in side.items()} for side in lab] for lab in soft]
        done, rate = abs(new - rate) < tolerance, min(max(new, 1e-6), 1 - 1e-6)
        if done:
            break
    return rate, chances, posterior


def _inputs(f: tuple[int, ...]) -> list[float]:
    out = [1.0]
    for v in f[:len(LABELERS)]:
        out += [float(v == 1), float(v == -1)]
    size, upper, lower = f[len(LABELERS):]
    return [*out, *[float(size == s) for s in (1, 2, 3)], float(upper), float(lower)]


def fit_classifier(table, posterior, rounds: int = 30, ridge: float = 1.0) -> list[float]:
    """Ridge logistic regression on the EM posteriors (Newton), weighted by
    counts; the ridge pulls towards a start that sums the votes.  The counts of
    all candidates enter; they are scaled down to ``MAX_EVIDENCE`` in all, so that
    the start keeps a say however large the corpus is."""
    import numpy as np
    start = np.array(_start_weights())
    w = start.copy()
    if not table:
        return w.tolist()
    x = np.array([_inputs(f) for f, _ in table])
    n = np.array([c for _, c in table], float)
    n = n / n.sum() * min(n.sum(), MAX_EVIDENCE)
    y = np.array([posterior(f) for f, _ in table])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + ridge * (w - start)
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def _start_weights() -> list[float]:
    return [-2.0, *[x for _ in LABELERS for x in (1.5, -1.5)], 0.0, 0.0, 0.0, 0.0, 0.0]


def train(docs: DataFrame) -> list[float]:
    """Weights of the span classifier, learnt from all rows of ``docs``."""
    table = vote_table(docs)
    _, _, posterior = estimate(table)
    return fit_classifier(table, posterior)


def _probability(f: Column, weights: list[float]) -> Column:
    z, k = F.lit(weights[0]), 1
    for name in LABELERS:
        z = z + F.when(f[name] == 1, weights[k]).when(f[name] == -1, weights[k + 1]).otherwise(0.0)
        k += 2
    for s in (1, 2, 3):
        z = z + F.when(f["size"] == s, weights[k]).otherwise(0.0)
        k += 1
    z = z + f["upper"] * F.lit(weights[k]) + f["lower"] * F.lit(weights[k + 1])
    return 1 / (1 + F.exp(-z))


def with_spans(docs: DataFrame, weights: list[float]) -> DataFrame:
    """``docs`` with ``_pii_<kind>`` arrays of (s, e) for every kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("*", *[base_spans(text, k).alias(f"_pii_{k}") for k in BASE_KINDS])
    base = F.concat(*[F.col(f"_pii_{k}") for k in BASE_KINDS])
    d = d.withColumn("_pii_secret", candidates(text, base))
    accepted = F.filter("_pii_secret", lambda c: let(_described(c), lambda f: _probability(f, weights) >= MIN_PROBABILITY))
    d = d.withColumn("_pii_secret", F.when(F.size("_pii_secret") > 0, accepted).otherwise(F.col("_pii_secret")))
    return d.withColumns({f"_pii_{k}": F.transform(f"_pii_{k}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS})


def _each(kinds, told) -> Column:
    """``told(kind, span)`` of all spans, kind by kind."""
    def of(kind):
        return F.transform(f"_pii_{kind}", lambda x: told(kind, x))
    return F.concat(*[of(k) for k in kinds])


def _listed(kinds) -> Column:
    return F.array_join(_each(kinds, lambda kind, x: F.concat_ws(":", F.lit(kind), x["s"], x["e"])), ",")


def find_personal_data(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, base_sha256, spans, n_secret."""
    d = docs.select("doc_id", "text")
    d = with_spans(d, weights if weights is not None else train(d))
    return d.select(
        "doc_id", *[F.size(f"_pii_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"), F.size("_pii_secret").cast("long").alias("n_secret"))


def redact(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, same columns;
    ``n_chars`` follows the new text where the column exists and is not null."""
    # other columns wait under plain names, whatever theirs are
    place = {c: c if c in ("text", "n_chars") else f"c{i}" for i, c in enumerate(docs.columns)}
    d = with_spans(docs.select(*[F.col(f"`{c}`").alias(place[c]) for c in docs.columns]), weights if weights is not None else train(docs))
    every = F.array_sort(_each(KINDS, lambda kind, x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{kind.upper()}]").alias("k"))))

    def merged(spans: Column) -> Column:  # sorted spans; those that overlap become one
        ends = F.transform(spans, lambda x: x["e"])

        def rebuilt(upto: Column) -> Column:  # where all spans before each one end
            pieces = F.transform(spans, lambda x, i: F.when(x["s"] >= F.get(upto, i), F.concat(
                F.substring(F.col("text"), F.get(upto, i) + 1, x["s"] - F.get(upto, i)), x["k"])))
            rest = F.substring(F.col("text"), F.array_max(ends) + 1, F.length("text"))
            return F.concat(F.array_join(F.array_compact(pieces), ""), rest)
        return let(let(ends, lambda e: _before(e, lambda a, x: F.greatest(a, x))), rebuilt)

    text = F.when(F.size("_pii_all") > 0, merged(F.col("_pii_all"))).otherwise(F.col("text"))
    d = d.withColumn("_pii_all", every).withColumn("_pii_text", text)
    out = {c: F.col(place[c]).alias(c) for c in docs.columns} | {"text": F.col("_pii_text").alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("n_chars").isNotNull() & (F.size("_pii_all") > 0), F.length("_pii_text")).otherwise(F.col("n_chars")).cast(kind).alias("n_chars")
    return d.select(*out.values())
