"""Every name has a rule, and every licence is found by its SPDX identifier."""

import re

import pytest

from assetweave.llm import licenses
from assetweave.llm.license_rules import GATE, NAMES, OPENINGS, keyword_of, rules

ALONE = {
    "gpl-2.0": ["GPLv2", "GPLv2.0"],
    "gpl-3.0": ["GPLv3", "GPLv3.0"],
    "lgpl-3.0": ["LGPLv3"],
    "agpl-3.0": ["AGPLv3"],
    "cecill": ["CeCILL", "CeCILL-B license"],
    "openrail": ["OpenRAIL", "OpenRAIL-M license"],
}
SPDX = {
    "mit": "MIT", "mit-0": "MIT-0", "isc": "ISC", "zlib": "Zlib", "libpng": "Libpng", "openssl": "OpenSSL", "ruby": "Ruby",
    "python-2.0": "Python-2.0", "php-3.01": "PHP-3.01", "php": "PHP-3.0", "postgresql": "PostgreSQL", "ncsa": "NCSA",
    "unicode": "Unicode-DFS-2016", "w3c": "W3C", "vim": "Vim", "json": "JSON", "ijg": "IJG", "curl": "curl",
    "beerware": "Beerware", "elastic-2.0": "Elastic-2.0", "mpl": "MPL-1.0", "mpl-2.0": "MPL-2.0", "osl": "OSL-2.1",
    "osl-3.0": "OSL-3.0", "afl": "AFL-2.1", "ofl": "OFL-1.0", "gpl-2.0": "GPL-2.0-only", "bsd-3-clause": "BSD-3-Clause",
    "apache-2.0": "Apache-2.0", "bsl-1.0": "BSL-1.0", "cc0-1.0": "CC0-1.0", "unlicense": "Unlicense", "0bsd": "0BSD",
}


def test_every_name_has_a_rule_of_its_own():
    patterns = {r.pattern for r in rules()}
    assert {f"^{name} " for _, _, names in NAMES for name in names} <= patterns
    assert all(keyword_of(r.pattern[1:-1]) == r.keyword for r in rules())


@pytest.mark.parametrize("words", ["licen[cs]e of", "(?:a )?b", "gpl(?:v2)?", "gpl(?: 2|v3)?", "gpl2? x"])
def test_a_rule_without_a_plain_first_word_is_refused(words):
    with pytest.raises(ValueError):
        keyword_of(words)


def test_labels(spark):
    wanted = [(text, label, 0) for label, texts in ALONE.items() for text in texts]
    wanted += [(f"SPDX-License-Identifier: {text}", label, 1) for label, text in SPDX.items()]
    wanted += [(f"{opening.title()} {text}", label, 1) for label, text in SPDX.items() for opening in OPENINGS]
    docs = spark.createDataFrame([(i, f"This code: {t}") for i, (t, _, _) in enumerate(wanted)], "doc_id long, text string")
    for r in licenses.license_labels(docs).collect():
        text, label, first = wanted[r.doc_id]
        assert r.labels == label and r.score >= (1.0 if first else 0.8), (text, r.labels, r.score)


def test_identifiers_are_not_names_by_themselves(spark):
    docs = spark.createDataFrame([(1, "zlib and json at MIT, in ruby, by curl")], "doc_id long, text string")
    assert licenses.license_labels(docs).first().labels == ""


def test_gate_holds_the_keywords_of_names_that_need_it():
    for rule in rules():
        plain = re.sub(r"licen\[cs\]e", "license", rule.pattern)
        assert {*re.findall(r"[a-z0-9]+", plain)} & {*GATE}, rule
