"""Wrapped headers, whole licence files and notices inside long lines, and similarities against plain TF-IDF."""

import math
import re
import textwrap
from collections import Counter

from tapelake.llm import licenses

FILE = "doc_id long, path string, text string"


def wrapped(text, mark="", width=70):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def own_licences(spark, files):
    return {r.doc_id: (r.license, r.origin) for r in licenses.licenses(spark.createDataFrame(files, FILE)).collect()}


def test_wrapped_headers_and_licence_files(spark):
    grant, warranty = licenses._GRANT, licenses._MIT_WARRANTY.upper()
    code = "\nimport os\n\nfor path in os.listdir(folder):\n    print(path, len(path))\n" * 20
    who = "Copyright (c) 2019 Someone Somewhere and Friends\n"
    gnu = [licenses._GNU.format(3), licenses._GNU_WARRANTY, licenses._GNU_COPY]
    apache = licenses.TEXTS[9][1]
    long_line = "Nothing here says much about rights. " * 30 + "Released under the MIT License. " + "Nor does any of this sentence. " * 30
    files = [
        (1, "m/LICENSE", f"MIT License\n\n{who}\n{wrapped(grant)}\n\n{wrapped(warranty)}\n"), (2, "m/a.py", "import os"),
        (3, "i/LICENSE", f"{who}\n{wrapped(licenses._ISC_GRANT)}\n\n{wrapped(licenses._ISC_WARRANTY.upper())}\n"), (4, "i/deep/a.py", "x"),
        (5, "g/a.py", "# " + who + "#\n" + "\n#\n".join(wrapped(t, "# ") for t in gnu) + code), (6, "g/b.py", "y"),
        (7, "b/a.c", "/*\n * " + who + " *\n" + wrapped(f"{licenses._BSD_GRANT} {licenses._BSD_NAMES}", " * ") + "\n *\n" + wrapped(licenses._BSD_WARRANTY, " * ") + "\n */" + code),
        (8, "b/LICENSE.txt", wrapped(f"{licenses._BSD_GRANT} {licenses._BSD_WARRANTY}", width=50)),
        (9, "a/a.scala", "/*\n" + wrapped(apache, " * ", 60) + "\n */" + code), (10, "l/a.txt", long_line),
        (11, "h/a.py", wrapped(grant, "// ", 40) + code), (12, "p/a.py", code), (13, "p/LICENSE", "whatever\nyou like\n\n" * 50),
        (14, "c/COPYING", "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\n" + "Everyone may read these words aloud in public squares.\n" * 40), (15, "c/x.c", "int x;"),
        (16, "e/LICENSE", None), (17, "e/COPYING", "\n" * 100_000), (18, "d/LICENSE", (wrapped(grant) + "\n\n") * 300),
    ]
    assert own_licences(spark, files) == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("ISC", "own"), 4: ("ISC", "inherited"), 5: ("GPL-3.0", "own"), 6: (None, None),
        7: ("BSD-3-Clause", "own"), 8: ("BSD-2-Clause", "own"), 9: ("Apache-2.0", "own"), 10: ("MIT", "own"), 11: ("MIT", "own"),
        12: (None, None), 13: (None, None), 14: ("GPL-2.0", "own"), 15: ("GPL-2.0", "inherited"), 16: (None, None), 17: (None, None),
        18: ("MIT", "own"),
    }


def plain(units, templates, n_lines):
    """The best cosine of each unit by dictionaries; ``units`` are lists of terms with a count of occurrences."""
    words = {c: Counter(t for t in c.split() if t not in licenses.STOP_WORDS) for c in units}
    other = [(name, Counter(t for t in re.findall(licenses.TERM, text.lower()) if t not in licenses.STOP_WORDS)) for name, text in templates]
    known = {t for _, terms in other for t in terms}
    df = Counter()
    for c, n in units.items():
        for t in words[c]:
            df[t] += n
    rarest = 1 + math.log(n_lines + 1)
    idf = lambda t: rarest - math.log1p(df[t]) if t in known else rarest
    size = lambda terms: math.sqrt(sum((n * idf(t)) ** 2 for t, n in terms.items()))
    best = {}
    for c, terms in words.items():
        for name, wanted in other:
            if terms and size(terms):
                cosine = sum(n * wanted[t] * idf(t) ** 2 for t, n in terms.items()) / size(terms) / size(wanted)
                best[c] = min(best.get(c, (0.0, "")), (-round(cosine, 6), name))
    return best


def test_similarities_equal_plain_tf_idf(spark):
    texts = [text for _, text in licenses.TEMPLATES + licenses.TEXTS]
    units = {" ".join(re.findall(licenses.TERM, t.lower())): 1 + k % 4 for k, t in enumerate(texts)}
    units |= {" ".join(c.split()[: len(c.split()) * 2 // 3] + ["unknown", "words"]): 2 for c in list(units)}
    templates = licenses.TEMPLATES + licenses.TEXTS
    frame = spark.createDataFrame(list(units.items()), "content string, n long")
    got = {r.content: (r.similarity, r.license) for r in licenses.matched_lines(frame, 500, templates, 0.75).collect()}
    want = {c: (-s, name) for c, (s, name) in plain(units, templates, 500).items() if -s >= 0.75}
    assert got.keys() == want.keys() and len(got) > 50
    assert all(abs(got[c][0] - want[c][0]) < 2e-6 for c in want) and sum(got[c][1] == want[c][1] for c in want) == len(want)


def test_rarity_is_counted_over_all_lines(spark):
    """Lines that are no notices themselves make a template's word common, and so a notice with it less telling."""
    notice, other = "Released under the MIT License today", "The license fee of seven grey horses was paid again that winter"
    files = [(1, "a/b/x.txt", f"{notice}\nnothing\n\n"), (2, "c/y.txt", "\n".join([other] * 300))]
    row = licenses.licenses(spark.createDataFrame(files, FILE)).filter("doc_id = 1").collect()[0]
    units = {" ".join(re.findall(licenses.TERM, t.lower())): n for t, n in ((notice, 1), ("nothing", 1), ("", 2), (other, 300))}
    similarity, name = plain(units, licenses.TEMPLATES, 304)["released under the mit license today"]
    assert (row.license, row.origin, name) == ("MIT", "own", "MIT")
    assert abs(row.similarity + similarity) < 2e-6 and row.similarity < 0.85
