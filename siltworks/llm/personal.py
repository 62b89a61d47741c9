"""Personal data in whole texts, by weak supervision, in DataFrame functions only.

Three sorts of labelers propose spans: patterns; gazetteers, which look for entries of tables (mail
providers, dialling codes, card issuers) in forms that the patterns do not take; and contexts, which
look at what follows cue words or is spelt out ("call 0171 ...", "name at host dot com"). For each span
all labelers vote for, against, or not at all: the check of what proposed it, the tables, cue words in
front of it, what it touches, and how varied its characters are. Only counts of vote patterns, a table
bounded by the number of labelers and features, come to the driver. There expectation-maximisation
estimates how reliable each labeler is, and a logistic span classifier is trained on the labels that
follow. It goes back as an expression.

Spans of the four base patterns that pass their check always stay; the classifier adds others.

Places are found without Python: a pattern splits the text, and the lengths of parts and matches,
added up in stretches of `STRETCH` matches, give the code points; so time grows in proportion to the
matches of a text. Patterns are written so that a search takes linear time also in long runs of digits
or letters: they start at the edge of a run or where the last match ended, or look a bounded way back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stored

#: Tables of the gazetteers.
PROVIDERS = (
    "gmail", "googlemail", "yahoo", "ymail", "outlook", "hotmail", "live", "msn", "icloud", "aol", "proton",
    "protonmail", "zoho", "fastmail", "gmx", "web", "freenet", "posteo", "mailbox", "orange", "laposte", "free",
    "wanadoo", "terra", "telefonica", "libero", "mail",
)
DOMAINS = (
    "com", "org", "net", "edu", "gov", "info", "biz", "io", "de", "at", "ch", "fr", "es", "it", "pt", "nl", "be",
    "uk", "eu", "ie", "pl", "se", "no", "dk", "us", "ca", "mx", "ar", "cl", "br", "au", "nz", "jp", "cn", "in",
)
DIALLING = (
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
    "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
    "86", "90", "91", "92", "94", "98", "212", "213", "216", "234", "254", "351", "352", "353", "354", "358", "359",
    "370", "371", "372", "380", "381", "385", "386", "420", "421", "593", "595", "598", "852", "886", "966", "971", "972",
)
ISSUERS = (
    "4", "5[1-5]", "222[1-9]", "22[3-9]", "2[3-6]", "27[01]", "2720", "3[47]", "30[0-5]", "3[68]", "352[89]",
    "35[3-8]", "6011", "64[4-9]", "65", "62", "50", "5[6-8]",
)
KEY_STARTS = ("AKIA", "ASIA", "ghp", "gho", "ghs", "glpat", "sk", "pk", "rk", "xox", "AIza", "eyJ", "SG")
FIRST_NAMES = (
    "james", "john", "robert", "michael", "william", "david", "richard", "thomas", "charles", "daniel", "mark",
    "paul", "george", "peter", "kevin", "brian", "mary", "patricia", "jennifer", "linda", "elizabeth", "barbara",
    "susan", "jessica", "sarah", "karen", "lisa", "nancy", "anna", "emma", "olivia", "alice", "jane", "kate", "hans",
    "klaus", "jürgen", "wolfgang", "stefan", "andreas", "markus", "uwe", "sabine", "petra", "monika", "ursula",
    "heike", "claudia", "jean", "pierre", "michel", "philippe", "alain", "jacques", "marie", "nathalie", "isabelle",
    "sylvie", "catherine", "sophie", "jose", "juan", "antonio", "manuel", "francisco", "carlos", "jesus", "javier",
    "miguel", "luis", "pedro", "maria", "carmen", "ana", "isabel", "dolores", "pilar", "teresa", "lucia", "elena",
)
#: Cue words in front of a span of a kind, and of what it is not.
CUE_WORDS = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel", "schreib"),
    "ip": (r"\bip\b", "host", "server", "address", "adresse", "dirección"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", r"\btel", "call", "fax", "mobile", "handy", "telefon", "móvil", "rufen", "llame", "appelez"),
    "secret": (r"(?:password|passwd|pwd|token|secret|key)[\x20\"'=:]*$",),
}
AGAINST = r"(?i)(version|isbn|license|invoice|order|page|\bno\.|commit|sha)[\x20#:=]*$"
_CALL = "call|phone|telephone|tel|fax|mobile|cell|handy|telefon|telefono|teléfono|móvil|mobil|rufen|llame|appelez|portable"
_BETWEEN = "me|us|him|her|at|on|is|now|nr|no|sie|unter|al|au"
_NAMED = "password|passwd|pwd|passwort|contraseña|token|secret|api_key|api-key|apikey"


def _has(*words: str):
    """Whether a text holds one of the words; a plain search, before a pattern is tried."""

    def needed(t: Column, lower: Column) -> Column:
        found = F.contains(lower, F.lit(words[0]))
        for word in words[1:]:
            found = found | F.contains(lower, F.lit(word))
        return found

    return needed


def _any(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


#: Kinds in the order of their listing, and their patterns. Possessive repeats and the
#: edges in front change no match; they keep the search linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Proposed by this library alone: keys and passwords, which mix letters and digits.
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{16,}+",
}
KINDS = tuple(PATTERNS)
#: What a text must hold for a pattern to be tried at all.
NEEDED = {
    "email": _has("@"),
    "ip": lambda t, _: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t, _: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t, _: t.rlike(r"\+[0-9]"),
    "secret": lambda t, _: t.rlike(r"[A-Za-z][0-9]|[0-9][A-Za-z]"),
}
_START = r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{1,64}+"
_DOT = r"(?:\[\.\]|\(\.\)|\x20dot\x20)"
#: Further proposals, by sort of labeler: (kind, pattern, what a text must hold). They are written so
#: that none overlaps a span of the kind's own pattern.
GAZETTEERS = (
    (
        "email",
        rf"(?i){_START}(?:(?:\x20@\x20?|@\x20){_any(PROVIDERS)}(?:\.[a-z]{{2,10}}){{0,2}}(?![A-Za-z0-9@-])"
        rf"|@{_any(PROVIDERS)}(?!\.?[A-Za-z0-9@-]))",
        _has("@"),
    ),
    (
        "phone",
        rf"(?<![0-9+.(-])(?<!\+[0-9][\x20().0-9-]{{0,24}})00\x20?{_any(DIALLING)}[\x20().0-9-]{{6,18}}[0-9](?![0-9])",
        lambda t, low: _has("00")(t, low) & t.rlike(r"00\x20?[0-9]"),
    ),
    (
        "card",
        rf"(?<![0-9.])(?={_any(ISSUERS)})[0-9]{{4}}([./_])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{1,4}}(?![0-9])",
        lambda t, _: t.rlike(r"[0-9]{4}[./_][0-9]{4}[./_]"),
    ),
)
CONTEXTS = (
    (
        "email",
        rf"(?i){_START}\x20?[\x20(\[{{]at[\x20)\]}}]\x20?[A-Za-z0-9-]{{1,63}}"
        r"(?:\x20?[\x20(\[{]dot[\x20)\]}]\x20?[A-Za-z0-9-]{2,63}){1,4}+(?![A-Za-z0-9._%+-]{0,64}@)",
        _has(" dot ", "(dot)", "[dot]", "{dot}"),
    ),
    (
        "ip",
        rf"(?<![0-9])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])",
        _has("[.]", "(.)", " dot "),
    ),
    (
        "phone",
        rf"(?=[(0-9])(?<=(?i)\b(?:{_CALL})\b[\x20.:#]{{1,3}}(?:(?:{_BETWEEN})[\x20.:#]{{1,2}})?(?:(?:{_BETWEEN})[\x20.:#]{{1,2}})?)"
        r"\(?[0-9][\x20().0-9/-]{5,18}[0-9](?![0-9])",
        lambda t, low: t.rlike(r"[0-9][\x20().0-9/-]{5,18}[0-9]") & _has(*_CALL.split("|"))(t, low),
    ),
    (
        "secret",
        rf"(?<=(?i)\b(?:{_NAMED})\x20{{0,2}}[=:]\x20{{0,2}}[\"']{{0,1}})(?![\x20=:\"'])(?![A-Za-z0-9]{{16}})[^\s\"',;<>]{{8,64}}",
        _has(*_NAMED.split("|")),
    ),
)
PATTERN, GAZETTEER, CONTEXT_CUE = range(3)
#: What a span of a kind holds that is in a table.
HOLDS = {
    "email": rf"(?i)(\.|\bdot\b[)\]}}]?\x20?){_any(DOMAINS)}$|[@\x20]{_any(PROVIDERS)}\b|^{_any(FIRST_NAMES)}\b",
    "ip": r"^(?!0)(?!127\.)(?!255\.)",
    "card": rf"^{_any(ISSUERS)}",
    "phone": rf"^(\+|00\x20?){_any(DIALLING)}|^\(?0[1-9]",
    "secret": rf"^{_any(KEY_STARTS)}|^[0-9a-f]+$",
}
CUES = {kind: "(?i)(" + "|".join(words) + ")" for kind, words in CUE_WORDS.items()}
LABELERS = ("check", "holds", "cue", "edge", "variety")
FEATURES = ("long", "digits", "split", "lower", "gazetteer", "context")
CONTEXT = 32
#: Matches whose lengths are added up in one go.
STRETCH = 256


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        doubled = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * (F.lit(1) + (i - 1) % 2)
        return total + doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "secret":
        return F.lit(False)
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("tinyint")


def _check(kind: str, by: int, value: Column) -> Column:
    """Vote of what proposed the span, on its content."""
    if by == PATTERN:
        valid = _valid(kind, value)
        return _vote(valid, ~valid & F.lit(kind != "secret"))
    digits = _digits(value)
    if kind == "phone":
        fits = F.length(digits).between(7, 13) if by == CONTEXT_CUE else F.length(digits).between(9, 15)
    elif kind == "card":
        fits = F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    elif kind == "ip":
        fits = _valid("ip", F.regexp_replace(value, _DOT, "."))
    else:
        return F.lit(0).cast("tinyint")
    return _vote(fits, ~fits)


def _span(kind: str, by: int, start: Column, value: Column, before: Column, after: Column) -> Column:
    valid = _valid(kind, value) if by == PATTERN else F.lit(False)
    touches = before.rlike(r"[A-Za-z0-9_]$") | after.rlike(r"^[A-Za-z0-9_]")
    varied = F.size(F.array_distinct(F.split(value, "")))
    votes = {
        "check": _check(kind, by, value),
        "holds": _vote(value.rlike(HOLDS[kind]), F.lit(False)),
        "cue": _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)),
        "edge": _vote(~touches, touches),
        "variety": _vote(varied >= 8, varied <= 3),
    }
    features = {
        "long": F.length(value) >= 20,
        "digits": F.length(_digits(value)) * 2 >= F.length(value),
        "split": value.rlike(r"[\x20().-]"),
        "lower": value.rlike("[a-z]"),
        "gazetteer": F.lit(by == GAZETTEER),
        "context": F.lit(by == CONTEXT_CUE),
    }
    return F.struct(
        start.alias("start"),
        (start + F.length(value)).alias("end"),
        F.lit(KINDS.index(kind)).alias("kind"),
        valid.alias("valid"),
        *(votes[name].alias(name) for name in LABELERS),
        *(features[name].alias(name) for name in FEATURES),
    )


_SPAN = (
    "array<struct<start:int,end:int,kind:int,valid:boolean,"
    + ",".join([f"{x}:tinyint" for x in LABELERS] + [f"{x}:boolean" for x in FEATURES])
    + ">>"
)


def _starts(steps: Column) -> Column:
    """Where each match starts, from the lengths (part, value) of matches and the text before each.

    Lengths are added up by stretches, then the stretches, then within each from where it starts: an
    array that grows is never longer than a stretch, or than the number of stretches.
    """
    step = lambda s: s["part"] + s["value"]
    nothing = F.array().cast("array<int>")

    def running(lengths: Column, first: Column, before, of) -> Column:
        grown = F.aggregate(
            lengths,
            F.struct(first.alias("at"), nothing.alias("out")),
            lambda so_far, x: F.struct(
                (so_far["at"] + of(x)).alias("at"),
                F.concat(so_far["out"], F.array(so_far["at"] + before(x))).alias("out"),
            ),
        )
        return grown["out"]

    def stretch(k: Column) -> Column:
        return F.slice(steps, k * STRETCH + 1, STRETCH)

    every = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / STRETCH).cast("int"))
    sums = F.transform(every, lambda k: F.aggregate(stretch(k), F.lit(0), lambda total, s: total + step(s)))
    firsts = F.array(running(sums, F.lit(0), lambda _: F.lit(0), lambda x: x))
    placed = F.transform(
        firsts,
        lambda first: F.flatten(
            F.transform(every, lambda k: running(stretch(k), F.get(first, k), lambda s: s["part"], step))
        ),
    )
    return F.get(placed, 0)


def _proposed(kind: str, by: int, pattern: str, needed: Column, text: Column) -> Column:
    """All matches of a pattern, leftmost first and not overlapping, as spans with votes and features."""
    none = F.array().cast(_SPAN)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)

    def once(*columns: Column) -> Column:
        """One element, so that arrays are made once and then read by place."""
        return F.array(F.struct(*columns))

    def spans(found: Column) -> Column:
        steps = F.transform(
            found["values"],
            lambda v, i: F.struct(F.length(F.get(found["parts"], i)).alias("part"), F.length(v).alias("value")),
        )
        placed = F.transform(once(steps.alias("steps")), lambda s: F.struct(_starts(s["steps"]).alias("starts")))

        def span(start: Column, i: Column) -> Column:
            before, after = F.get(found["parts"], i), F.get(found["parts"], i + 1)
            return _span(kind, by, start, F.get(found["values"], i), F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(1)))

        every = F.get(F.transform(placed, lambda p: F.transform(p["starts"], span)), 0).cast(_SPAN)
        return F.when(F.size(found["values"]) == 0, none).otherwise(every)

    held = once(values.alias("values"), parts.alias("parts"))
    return F.when(needed, F.get(F.transform(held, spans), 0)).otherwise(none)


def proposed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): for each row its spans of every kind, with votes and features. Null is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ways = [(kind, PATTERN, pattern, NEEDED[kind]) for kind, pattern in PATTERNS.items()]
    ways += [(kind, GAZETTEER, pattern, needed) for kind, pattern, needed in GAZETTEERS]
    ways += [(kind, CONTEXT_CUE, pattern, needed) for kind, pattern, needed in CONTEXTS]
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("lower", F.lower("text"))
    t, low = F.col("text"), F.col("lower")
    return rows.select(
        "id", F.concat(*(_proposed(kind, by, pattern, needed(t, low), t) for kind, by, pattern, needed in ways)).alias("spans")
    )


@dataclass
class Model:
    """What is estimated: by kind and labeler, shares of votes (against, none, for) for spans that
    are none and are; and the classifier's weights."""

    reliability: np.ndarray
    prior: np.ndarray
    weights: np.ndarray


def aggregate_votes(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 30):
    """Expectation-maximisation over vote patterns: (posterior of each pattern, prior, reliability).

    It starts from the share of votes in favour. The check of a pattern counts double at the start,
    so that the classes cannot be exchanged.
    """
    lead = np.ones(votes.shape[1])
    lead[0] = 2
    posterior = np.clip(0.5 + 0.5 * (votes @ lead) / (np.abs(votes) @ lead + 1), 0.05, 0.95)
    n, labelers = len(KINDS), votes.shape[1]
    prior, shares = np.full(n, 0.5), np.full((n, labelers, 2, 3), 1 / 3)
    for _ in range(rounds):
        for kind in range(n):
            own = kinds == kind
            if not own.any():
                continue
            weight = np.stack([counts[own] * (1 - posterior[own]), counts[own] * posterior[own]])
            total = weight.sum(axis=1)
            prior[kind] = (total[1] + 1) / (total.sum() + 2)
            for k in range(labelers):
                for v in (-1, 0, 1):
                    shares[kind, k, :, v + 1] = (weight[:, votes[own, k] == v].sum(axis=1) + 1) / (total + 3)
        logs = np.log(shares)[kinds[:, None], np.arange(labelers)[None, :], :, votes + 1].sum(axis=1)
        odds = logs[:, 1] - logs[:, 0] + np.log(prior / (1 - prior))[kinds]
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, prior, shares


def _inputs(kinds: np.ndarray, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
    return np.hstack([np.eye(len(KINDS))[kinds], votes == 1, votes == -1, features]).astype(np.float64)


def train_classifier(x: np.ndarray, y: np.ndarray, counts: np.ndarray, rounds: int = 25, ridge: float = 1.0):
    """Logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - y)) + ridge * w
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def train(found: DataFrame) -> Model:
    """Learn from all spans of `found` (see `proposed`), of which only pattern counts are gathered."""
    names = ["kind", *LABELERS, *FEATURES]
    rows = (
        found.select(F.explode("spans").alias("span"))
        .groupBy(*(F.col("span")[name].alias(name) for name in names))
        .count()
        .collect()
    )
    # At most kinds * 3^labelers * 2^features rows.
    rows = sorted(tuple(r) for r in rows)
    if not rows:
        size = len(KINDS) + 2 * len(LABELERS) + len(FEATURES)
        return Model(np.empty(0), np.empty(0), np.zeros(size))
    table = np.array(rows, dtype=np.int64)
    kinds, votes = table[:, 0], table[:, 1 : 1 + len(LABELERS)]
    features, counts = table[:, 1 + len(LABELERS) : -1], table[:, -1].astype(np.float64)
    posterior, prior, shares = aggregate_votes(kinds, votes, counts)
    return Model(shares, prior, train_classifier(_inputs(kinds, votes, features), posterior, counts))


def probability(span: Column, model: Model) -> Column:
    """The classifier as an expression over a span struct."""
    weights = [float(round(w, 9)) for w in model.weights]
    per_kind, rest = weights[: len(KINDS)], weights[len(KINDS) :]
    total = F.get(F.array(*map(F.lit, per_kind)), span["kind"])
    for k, name in enumerate(LABELERS):
        total = total + F.when(span[name] == 1, rest[k]).when(span[name] == -1, rest[k + len(LABELERS)]).otherwise(0.0)
    for k, name in enumerate(FEATURES):
        total = total + F.when(span[name], rest[k + 2 * len(LABELERS)]).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def decided(found: DataFrame, model: Model, *, least: float = 0.5) -> DataFrame:
    """(id, base, spans): spans that pass their check, and those with the added ones, by start and kind."""
    in_order = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"], s["valid"], probability(s, model).alias("p")))
    )
    told = found.select("id", F.filter(in_order, lambda s: s["valid"] | (s["p"] >= least)).alias("spans"))

    def last_of_equal(s: Column, i: Column) -> Column:
        """What two labelers propose counts once: of equal spans the one that passes, or is surest."""
        after = F.get("spans", i + 1)
        return ~F.coalesce(
            (after["start"] == s["start"]) & (after["kind"] == s["kind"]) & (after["end"] == s["end"]), F.lit(False)
        )

    return told.select(
        "id",
        F.filter("spans", lambda s: s["valid"]).alias("base"),
        F.filter("spans", last_of_equal).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id, base, spans) per row of `docs`: learns from all its spans, then decides on each.

    Spans are structs with start and end in code points. Null and empty text have none; repeated rows
    and rows without an id are judged like any other. Without any span nothing is learned or added.
    """
    found = stored(proposed(docs, id_col=id_col, text_col=text_col))
    return decided(found, train(found), least=least)
