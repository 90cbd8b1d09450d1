"""License scans: ordered signature rules behind a keyword gate.

A rule is a regular expression over the text's words, joined by single spaces, with a label,
a priority and keywords without any of which it cannot match: one for each way to say its
identifier or its title. One pass looks for keywords; only
texts that hold some are matched, and only against those keywords' rules. Detections lying
within another of the same or higher priority are suppressed, so "licensed under the MIT
license" is one notice and not also a title and a mention.

Only DataFrame functions are used and no rows meet, so nothing is shuffled.
"""

from __future__ import annotations

import itertools
import json
import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import ascii_lower

#: Fixed by the contract: word separators, phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, preferred keyword, identifier and title of each license, as regular expressions over
#: lower-cased words (punctuation is already a space). Written by hand.
LICENSES = (
    ("mit", "mit", "mit", "(?:mit|expat) licen[sc]e"),
    ("apache-2", "apache", "apache 2(?: 0)?", "apache(?: software)? licen[sc]e(?: version)? v?2(?: 0)?"),
    ("apache-1.1", "apache", "apache 1 1", "apache software license(?: version)? 1 1"),
    ("apache-1.0", "apache", "apache 1 0", "apache(?: software)? license(?: version)? 1 0"),
    ("bsd-2-clause", "bsd", "bsd 2 clause", "(?:simplified|2 clause|two clause|freebsd) bsd license"),
    ("bsd-3-clause", "bsd", "bsd 3 clause", "(?:new|revised|modified|3 clause|three clause) bsd license"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", "(?:original|4 clause|four clause) bsd license"),
    ("bsd-0-clause", "0bsd", "0bsd", "(?:0bsd|zero clause bsd)(?: license)?"),
    ("bsd", "bsd", "bsd", "bsd(?: style)? license"),
    ("gpl-1", "gpl", "gpl 1 0(?: only| or later)?", "gpl (?:version |v)?1(?: 0)?"),
    ("gpl-2", "gpl", "gpl 2 0(?: only| or later)?", "gpl (?:version |v)?2(?: 0)?"),
    ("gpl-2", "gplv2", "gplv2", "gplv2"),
    ("gpl-3", "gpl", "gpl 3 0(?: only| or later)?", "gpl (?:version |v)?3(?: 0)?"),
    ("gpl-3", "gplv3", "gplv3", "gplv3"),
    ("gpl", "gnu", "gpl", "gnu general public license"),
    ("gpl-2", "gnu", "gnu gpl v?2", "gnu general public license(?: as published by the free software foundation either)? (?:version |v)2"),
    ("gpl-3", "gnu", "gnu gpl v?3", "gnu general public license(?: as published by the free software foundation either)? (?:version |v)3"),
    ("lgpl-2", "lgpl", "lgpl 2 0(?: only| or later)?", "lgpl (?:version |v)?2(?: 0)?"),
    ("lgpl-2.1", "lgpl", "lgpl 2 1(?: only| or later)?", "lgpl (?:version |v)?2 1"),
    ("lgpl-3", "lgpl", "lgpl 3 0(?: only| or later)?", "lgpl (?:version |v)?3(?: 0)?"),
    ("lgpl", "lesser", "gnu lesser gpl", "gnu lesser general public license"),
    ("lgpl", "library", "gnu library gpl", "gnu library general public license"),
    ("agpl-3", "agpl", "agpl 3 0(?: only| or later)?", "agpl (?:version |v)?3(?: 0)?"),
    ("agpl", "affero", "affero gpl", "(?:gnu )?affero general public license"),
    ("gfdl", "gfdl", "gfdl(?: 1 [123])?", "gfdl"),
    ("gfdl", "documentation", "gnu fdl", "gnu free documentation license"),
    ("mpl-1.1", "mozilla", "mpl 1 1", "mozilla public license(?: version| v)? 1 1"),
    ("mpl-2", "mozilla", "mozilla 2 0", "mozilla public license(?: version| v)? 2(?: 0)?"),
    ("mpl-2", "mpl", "mpl 2 0", "mpl(?: version| v)? 2(?: 0)?"),
    ("epl-1", "eclipse", "epl 1 0", "eclipse public license(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", "epl 2 0", "eclipse public license(?: version| v)? 2(?: 0)?"),
    ("edl-1", "eclipse", "edl 1 0", "eclipse distribution license(?: version| v)? 1(?: 0)?"),
    ("cddl-1", "cddl", "cddl 1 [01]", "cddl(?: version| v)? 1(?: [01])?"),
    ("cddl-1", "development", "cddl license", "common development and distribution license"),
    ("cpl-1", "common", "cpl 1 0", "common public license(?: version| v)? 1(?: 0)?"),
    ("epl", "eupl", "eupl 1 [012]", "eupl(?: version| v)? 1(?: [012])?"),
    ("isc", "isc", "isc", "isc license"),
    ("zlib", "zlib", "zlib", "zlib(?: libpng)? license"),
    ("boost-1", "boost", "bsl 1 0", "boost software license(?: version)? 1 0"),
    ("artistic-1", "artistic", "artistic 1 0", "artistic license(?: version)? 1(?: 0)?"),
    ("artistic-2", "artistic", "artistic 2 0", "artistic license(?: version)? 2(?: 0)?"),
    ("unlicense", "unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql", "postgresql license"),
    ("python-2", "python", "python 2 0", "python software foundation license"),
    ("ruby", "ruby", "ruby", "ruby license"),
    ("php-3", "php", "php 3 0(?:1)?", "php license(?: version)? 3(?: 01?)?"),
    ("openssl", "openssl", "openssl", "openssl license"),
    ("ofl-1.1", "ofl", "ofl 1 1", "sil open font license(?: version)? 1 1"),
    ("bsl-1.1", "busl", "busl 1 1", "business source license(?: version)? 1 1"),
    ("sspl-1", "sspl", "sspl 1 0", "server side public license"),
    ("elastic-2", "elastic", "elastic 2 0", "elastic license(?: version)? 2(?: 0)?"),
    ("odbl-1", "odbl", "odbl 1 0", "open database license"),
    ("odc-by-1", "odc", "odc by 1 0", "open data commons attribution license"),
    ("pddl-1", "pddl", "pddl 1 0", "public domain dedication and license"),
    ("cc0-1", "cc0", "cc0(?: 1 0)?", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc", "cc by(?: [1-4] [05])?", "cc by [1-4] [05]"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative", "creative commons by", "creative commons attribution(?: [1-4] [05])?(?: international| unported)?"),
    ("cc-by-sa", "sharealike", "creative commons by sa", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "noncommercial", "creative commons by nc", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("public-domain", "domain", "public domain", "(?:in|to) the public domain"),
    ("proprietary", "proprietary", "licenseref proprietary", "proprietary and confidential"),
    ("all-rights-reserved", "reserved", "all rights reserved", "copyright(?: c)?(?: \\d{4})* .{0,60}all rights reserved"),
)

#: How a license is named: form, priority, confidence and the expression around it.
FORMS = (
    ("tag", 4, 1.0, "spdx license identifier {id}"),
    (
        "notice",
        4,
        0.95,
        "(?:licensed|released|distributed|available|provided|published|covered|dual licensed)"
        "(?: to you)? under (?:the )?(?:terms of (?:the )?)?{title}",
    ),
    ("under", 3, 0.9, "under (?:the |an? )?(?:terms of (?:the )?)?{title}"),
    ("title", 2, 0.8, "{title}"),
    ("field", 2, 0.7, "(?:license|licence|licensed|licenses) {id}"),
    ("mention", 1, 0.5, "{id} licen[sc]ed?"),
)
PRIORITIES = max(p for _, p, _, _ in FORMS)
_RULE = "array<struct<rule:int,label:string,keywords:array<string>,priority:int,confidence:double,regex:string>>"


#: Words too common for a keyword where an expression has another one.
_COMMON = frozenset(
    "a all and as by distribution either free general licence license of open or "
    "public software source the to under v version".split()
)
_PIECE = re.compile(r"\(\?:|[|()]|\[[^]]*\]|\\d|.")


@cache
def sayings(expression: str) -> tuple[str, ...]:
    """What an expression can stand for; of repetitions (``*``, ``{m,n}``) without any."""
    pieces = _PIECE.findall(re.sub(r"\(\?: \\d\{4\}\)\*|\.\{0,60\}", "", expression))

    def either() -> list[str]:
        out = sequence()
        while pieces and pieces[0] == "|":
            pieces.pop(0)
            out += sequence()
        return out

    def sequence() -> list[str]:
        out = [""]
        while pieces and pieces[0] not in "|)":
            piece = pieces.pop(0)
            if piece == "(?:":
                some = either()
                pieces.pop(0)
            else:
                some = list(piece[1:-1]) if piece[0] == "[" and "-" not in piece else [piece]
                if piece == "[1-4]":
                    some = list("1234")
            if pieces and pieces[0] == "?":
                pieces.pop(0)
                some = ["", *some]
            out = [a + b for a, b in itertools.product(out, some)]
        return out

    return tuple(dict.fromkeys(either()))


def _keywords(expression: str, preferred: str) -> list[str]:
    """Words of which everything that the expression matches holds one."""
    found = set()
    for saying in sayings(expression):
        words = saying.split()
        if preferred in words:
            found.add(preferred)
        else:
            found.add(max(words, key=lambda w: (w not in _COMMON, not w.isdigit(), len(w), w)))
    return sorted(found)


def rules() -> list[dict]:
    """Every license in every form, ordered; a rule's number is its place."""
    return [
        {
            "label": label,
            "keywords": _keywords(spdx if "{id}" in form else title, keyword),
            "priority": priority,
            "confidence": confidence,
            "regex": "(?<= )(?:" + form.format(id=spdx, title=title) + ")(?= )",
        }
        for label, keyword, spdx, title in LICENSES
        for _, priority, confidence, form in FORMS
    ]


def _any_of(words: list[str]) -> str:
    return "(?<= )(?:" + "|".join(words) + ")(?= )"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _spans(text: Column, rule: Column) -> Column:
    """Places where a rule matches: word numbers [first, last] of every match, in order."""
    pieces = F.split(text, rule["regex"], -1)
    found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    empty = F.array().cast(
        "array<struct<start:int,stop:int,priority:int,rule:int,label:string,confidence:double>>"
    )

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + _spaces(pair["piece"])
        last = first + _spaces(pair["match"])
        span = F.struct(
            first.alias("start"),
            last.alias("stop"),
            rule["priority"].alias("priority"),
            rule["rule"].alias("rule"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        )
        return F.struct(
            last.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")
        )

    pairs = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        found,
        lambda p, m: F.struct(p.alias("piece"), m.alias("match")),
    )
    start = F.struct(F.lit(-1).alias("at"), empty.alias("spans"))
    return F.aggregate(pairs, start, step, lambda s: s["spans"])


def _unsuppressed(spans: Column) -> Column:
    """Spans not inside another of the same or a higher priority.

    In the order (start, longer first, higher priority first) a container comes before what
    it contains, so the furthest end seen per priority decides.
    """
    kind = "array<struct<start:int,back:int,demoted:int,rule:int,label:string,confidence:double>>"
    ordered = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["stop"]).alias("back"),
                (-s["priority"]).alias("demoted"),
                s["rule"].alias("rule"),
                s["label"].alias("label"),
                s["confidence"].alias("confidence"),
            ),
        )
    )
    reach = F.array_repeat(F.lit(-1), PRIORITIES)

    def step(state: Column, s: Column) -> Column:
        above = F.array_max(F.slice(state["reach"], -s["demoted"], F.lit(PRIORITIES)))
        inside = above >= -s["back"]
        moved = F.transform(
            state["reach"],
            lambda end, i: F.when(i + 1 == -s["demoted"], F.greatest(end, -s["back"])).otherwise(end),
        )
        return F.struct(
            moved.alias("reach"),
            F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(s))).alias("kept"),
        )

    start = F.struct(reach.alias("reach"), F.array().cast(kind).alias("kept"))
    return F.aggregate(ordered, start, step, lambda s: s["kept"])


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score and detections (start and stop word, rule, label, confidence).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. NULL and
    empty texts have no words, no places (NULL first and last), empty labels and score 0. The
    score is the highest confidence of a detection or 1 where a base phrase stands. Rows are
    independent; repeated rows and other columns do not matter.
    """
    gate = _any_of(sorted({word for rule in rules() for word in rule["keywords"]}))
    base = _any_of(list(PHRASES))
    listed = F.from_json(
        F.lit(json.dumps([{"rule": i} | rule for i, rule in enumerate(rules())])), _RULE
    )
    plain = F.trim(
        F.regexp_replace(
            ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), SEPARATORS, " "
        )
    )
    text = F.col("_text")
    slim = docs.select("doc_id", F.concat(F.lit(" "), plain, F.lit(" ")).alias("_text"))
    read = slim.select(
        "doc_id",
        "_text",
        F.when(F.length(text) > 2, _spaces(text) - 1).otherwise(F.lit(0)).cast("long").alias("n_words"),
        F.regexp_extract_all(text, F.lit(gate), F.lit(0)).alias("_words"),
    ).withColumn("_gated", F.size("_words") > 0)
    # the phrases hold keywords of the gate, so texts that do not pass hold no phrase either
    places = F.when(F.col("_gated"), F.regexp_extract_all(text, F.lit(base), F.lit(0)))
    hits = F.when(
        F.col("_gated"),
        _unsuppressed(
            F.flatten(
                F.transform(
                    F.filter(listed, lambda r: F.arrays_overlap("_words", r["keywords"])),
                    lambda r: _spans(text, r),
                )
            )
        ),
    )
    found = read.withColumns(
        {"_base": places, "_kept": hits}
    ).withColumn("_outer", F.when(F.size("_base") > 0, F.split(text, base, -1)))
    known = F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair))
    base_labels = F.array_distinct(F.transform("_base", lambda p: F.element_at(known, p)))
    nothing = F.array().cast("array<string>")
    own = F.transform("_kept", lambda s: s["label"])
    some = F.size("_base") > 0
    last_phrase = F.element_at("_base", -1)
    return found.select(
        "doc_id",
        "n_words",
        F.greatest(F.size("_base"), F.lit(0)).cast("long").alias("n_base"),
        F.when(some, _spaces(F.element_at("_outer", 1)) - 1).cast("long").alias("first_word"),
        F.when(
            some,
            F.col("n_words") - _spaces(F.element_at("_outer", -1)) + 1 - _spaces(last_phrase) - 1,
        ).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.coalesce(base_labels, nothing)), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(
                F.array_distinct(F.concat(F.coalesce(base_labels, nothing), F.coalesce(own, nothing)))
            ),
            ",",
        ).alias("labels"),
        F.greatest(
            F.when(some, 1.0).otherwise(0.0),
            F.coalesce(F.array_max(F.transform("_kept", lambda s: s["confidence"])), F.lit(0.0)),
        ).alias("score"),
        F.transform(
            F.coalesce("_kept", F.array()),
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["back"]).alias("stop"),
                s["rule"].alias("rule"),
                s["label"].alias("label"),
                s["confidence"].alias("confidence"),
            ),
        ).alias("detections"),
    )
