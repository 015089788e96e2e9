import random
import re

import pytest

from strandlake.llm import licenses as li

TEXTS = [
    None, "", "Under the MIT License. cc-by-nc", "under  the\nmit\tlicense under the mit license", "xunder the mit license", "Apache License, Version 2.0 CC BY NC",
    "apache license version 2 apache license version 2", "under the mit licenses", "é under the mit license ü", "cc by", "// SPDX-License-Identifier: MIT OR (GPL-2.0 WITH Classpath-exception-2.0 AND Apache-2.0)",
    "SPDX-License-Identifier: (MIT", "cc by nc cc by nc " * 30, "All rights reserved.",
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in li.BASE.items():
        k = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(k)] == k:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base(spark, documents):
    rows = [*enumerate(TEXTS), *((d, t) for d, t in documents[1])]
    frame = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, labels string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in li.report(frame).collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=repr)


def test_labels_and_score(spark):
    rows = {r["doc_id"]: r for r in li.report(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}
    assert rows[10]["labels"] == "spdx:apache-2.0,spdx:classpath-exception-2.0,spdx:gpl-2.0,spdx:mit,terms:permissive"
    assert rows[10]["expressions"] == "mit gpl-2.0 classpath-exception-2.0 with apache-2.0 and or=permissive"
    assert rows[11]["labels"] == "" and rows[13]["labels"] == "notice-reserved"
    assert rows[0]["score"] == 0 and 0 < rows[13]["score"] < rows[2]["score"] < 1


def test_phrases_over_line_ends_and_marks():
    """Every phrase is found however its words are set apart, without other keywords in the text."""
    automaton = li._automaton()
    for phrase, label in (li.BASE | li.NOTICES).items():
        for gap in (" ", "  ", "\n# ", ", ", "\t", "\r\n * "):
            for text in (phrase, phrase.upper(), f"x {phrase} y"):
                found = li.scan_text(text.replace(" ", gap), automaton)
                assert label in found["labels"] and found["score"] > 0, (phrase, gap)
    assert li.scan_text("SPDX-License-Identifier: MIT", automaton)["labels"] == {"spdx:mit", "terms:permissive"}


def test_evaluation_reaches_the_result(spark):
    texts = {
        1: "SPDX-License-Identifier: GPL-3.0 AND MIT", 2: "SPDX-License-Identifier: GPL-3.0 OR MIT", 3: "SPDX-License-Identifier: MIT.",
        4: "SPDX-License-Identifier: MIT, and see NOTICE", 5: "SPDX-License-Identifier: MIT and see the notice", 6: "an SPDX license identifier is a name",
        7: "a b SPDX-License-Identifier: (MIT OR ISC) AND GPL-2.0+ */ x\n/* é SPDX-License-Identifier : BSD-3-Clause\nAND GPL-2.0",
        8: "SPDX-License-Identifier: see LICENSE", 9: "SPDX-License-Identifier:\nMIT",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["expressions"]) for r in li.report(frame).collect()}
    assert got[1] == ("spdx:gpl-3.0,spdx:mit,terms:other", "gpl-3.0 mit and=other")
    assert got[2] == ("spdx:gpl-3.0,spdx:mit,terms:permissive", "gpl-3.0 mit or=permissive")
    assert got[3] == got[4] == got[5] == ("spdx:mit,terms:permissive", "mit=permissive")
    assert got[6] == got[8] == got[9] == ("", "")
    assert got[7] == ("spdx:bsd-3-clause,spdx:gpl-2.0+,spdx:isc,spdx:mit,terms:other,terms:permissive", "mit isc or gpl-2.0+ and=other,bsd-3-clause=permissive")


def test_random_expressions():
    """The parser against a recursive reading of random trees."""
    rng = random.Random(1)
    names = ["MIT", "GPL-2.0", "Apache-2.0", "LGPL-3.0", "ISC", "MPL-2.0"]

    def tree(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            name = rng.choice(names)
            text = name + (" WITH Some-exception" if kind < 0.05 else "")
            return text, 3, name.lower() in li.PERMISSIVE
        word, rank = ("AND", 2) if kind < 0.65 else ("or", 1)
        (a, ra, va), (b, rb, vb) = tree(depth - 1), tree(depth - 1)
        wrap = lambda t, r: f"({t})" if r < rank else t
        return f"{wrap(a, ra)} {word} {wrap(b, rb)}", rank, (va and vb) if rank == 2 else (va or vb)

    for _ in range(300):
        text, _, value = tree(4)
        assert li.evaluate(li.to_postfix(text + rng.choice(["", ".", " */", ", then", " see below", "\n"])))[0] == value, text


def test_long_text_with_tags():
    automaton = li._automaton()
    text = "x " * 300_000 + "SPDX-License-Identifier: ISC\n" + "y " * 300_000 + "SPDX-License-Identifier: GPL-2.0 OR ISC"
    found = li.scan_text(text, automaton)
    assert [e["expression"] for e in found["expressions"]] == ["isc", "gpl-2.0 isc or"] and found["n_words"] == 600_012


def test_expressions():
    value = lambda t: li.evaluate(li.to_postfix(t))[0]
    assert value("MIT") and not value("GPL-3.0") and value("GPL-3.0 OR MIT") and not value("GPL-3.0 AND MIT")
    assert value("MIT OR GPL-2.0 AND GPL-3.0") and not value("(MIT OR GPL-2.0) AND GPL-3.0") and value("Apache-2.0 WITH LLVM-exception")
    assert li.to_postfix("a-1 or b-1 and c-1 with d-1") == ["a-1", "b-1", "c-1", "d-1", "with", "and", "or"]
    assert li.to_postfix("MIT and then some prose") == li.to_postfix("MIT OR") == ["mit"]
    for bad in ("", "OR MIT", "(MIT", "()", "(MIT OR", "then"):
        with pytest.raises(li.ExpressionError):
            li.to_postfix(bad)


def test_no_rows(no_documents):
    assert li.report(no_documents).count() == 0
