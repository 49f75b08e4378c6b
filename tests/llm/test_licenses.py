"""License rules: plain sentences, all rules tried without the keyword automaton, and long texts in linear time."""

import time

import pyarrow.parquet as pq
import pytest

from oslogs.llm import licenses

PLAIN = [
    "an artistic performance", "the apache helicopter", "a beerware joke", "we unlicense nothing", "Apache 2.4 server on PHP 3.0",
    "an elastic v neck", "Boost the software license fee", "python 2.0 and ruby 1.8", "the MIT campus", "a common public place",
    "Mulan the film", "sun public holiday", "open data commons of the town", "version 2.0 of everything", "a BSD system with three disks",
    "eclipse of the sun", "the academic free lunch", "GPL is a chemical abbreviation"[4:], "a boost for software", "vim and zlib and openssl",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_sentences_have_no_label(text):
    assert [d.label for d in licenses.scanner().scan(text)[2]] == []


@pytest.mark.parametrize("text, label", [
    ("Licensed under the Artistic License", "artistic"), ("under the Apache 2.0 terms", "apache-2.0"), ("released under Unlicense license", "unlicense"),
    ("Artistic-2.0", "artistic-2.0"), ("Beerware license", "beerware"), ("AGPL", "agpl"), ("is Apache licensed", "apache"), ("PHP License 3.01", "php-3.01"),
])
def test_short_forms_as_licenses(text, label):
    assert {d.label for d in licenses.scanner().scan(text)[2]} == {label}


def plain_detections(line):
    """Every rule over the whole line, then suppression by comparing with all that is accepted."""
    import re
    hits = []
    for i, rule in enumerate(licenses.scanner().rules):
        for m in rule.pattern.finditer(line):
            label = re.sub(r"(\d)-(?=\d)", r"\1.", m["name"].replace(" ", "-")) if rule.label == "spdx" else rule.label
            hits.append((-rule.priority, -(m.end() - m.start()), m.start(), i, m.end(), label))
    kept = []
    for _, _, a, i, b, label in sorted(hits):
        if not any(x <= a and b <= y for x, y, *_ in kept):
            kept.append((a, b, i, label))
    return [(label, line.count(" ", 0, a), line.count(" ", 0, b), line[a:b]) for a, b, i, label in sorted(kept)]


def test_detections_equal_all_rules_without_the_prefilter(sf_dir):
    texts = [t for t in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist() if t and len(t) < 20_000]
    texts += PLAIN + ["GPL v2 or later and the GNU Lesser General Public License version 2.1, CC BY-SA 4.0, SPDX-License-Identifier: MPL-2.0 apache license version 2.0 all rights reserved"]
    scan = licenses.scanner()
    some = 0
    for text in texts:
        line = scan.words(text).decode()
        found = [(d.label, d.first, d.last, d.text) for d in scan.detections(line)]
        assert found == plain_detections(line)
        some += len(found)
    assert some > 5


def test_long_texts_take_linear_time():
    def seconds(size):
        text = "the cc by and gpl version 2 or later " * (size // 37)
        begin = time.perf_counter()
        n, base, found = licenses.scanner().scan(text)
        assert len(base) == size // 37 and len(found) == 2 * (size // 37) and found[-1].last == n - 1
        return time.perf_counter() - begin

    seconds(50_000)
    assert seconds(1_000_000) < 5 * 1.6 * max(seconds(200_000), 0.05)
