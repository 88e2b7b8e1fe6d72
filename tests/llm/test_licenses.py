from conftest import DATA

from costmart.llm import licenses as L


def test_whole_and_altered_templates_are_found_with_spans():
    scanner = L.Scanner(L.TEMPLATES)
    for name, template in L.TEMPLATES.items():
        text = "Some words before it. İ " + template + " And some after it."
        found = scanner.scan(text)
        assert found[0][0] == name and found[0][1] == 1.0
        assert text[found[0][3] : found[0][4]].split()[0] == template.split()[0]
    altered = L.TEMPLATES["MIT"].replace("person", "woman or man").replace("merge, ", "")
    ((name, coverage, _, _, _),) = scanner.scan(altered)
    assert name == "MIT" and 0.95 < coverage < 1


def test_parts_below_the_coverage_are_left_alone():
    scanner = L.Scanner(L.TEMPLATES)
    half = " ".join(L.TEMPLATES["ISC"].split()[:60])
    assert scanner.scan(half) == []
    assert scanner.scan("this work is licensed to nobody under no terms whatsoever") == []
    assert L.Scanner({}).scan(L.TEMPLATES["MIT"]) == []


def test_alignment_equals_a_whole_table():
    def full(a, b):  # local alignment over all cells: equal 2, others and gaps -1
        best, row = 0, [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            best, row = max(best, *new), new
        return best

    a = L.TEMPLATES["GPL-3.0"].lower().split()
    for b in (a[3:], a[:20] + ["x"] + a[20:], a[:30] + a[33:], [w if i % 9 else "y" for i, w in enumerate(a)]):
        matched, first, last = L.align(a, b, 0)
        gaps = full(a, b)
        assert matched <= min(len(a), len(b)) and gaps <= 2 * matched and 0 <= first <= last < len(b)


def test_query_finds_every_planted_notice(spark, odd, none):
    marks = ("licensed under the", "licensed under cc", "released under the mit")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = {d.doc_id for d in docs if any(m in (d.text or "").lower() for m in marks)}
    assert want and {r.doc_id for r in L.query(spark, DATA).collect()} == want
    assert L.scan_documents(odd).count() == 0 and L.scan_documents(none).count() == 0


def test_siblings_are_not_reported_under_a_wrong_id():
    scanner = L.Scanner(L.TEMPLATES)
    names = lambda text: {m[0] for m in scanner.scan("Some words. " + text + " More words.")}
    by = "This work is licensed under a Creative Commons Attribution"
    assert names(f"{by}-NonCommercial-ShareAlike 4.0 International License") == {"CC-BY-NC-SA-4.0"}
    assert names(f"{by}-ShareAlike 4.0 International License") == {"CC-BY-SA-4.0"}
    assert names(f"{by} 3.0 Unported License") == set()
    assert names("This work is licensed under the GNU General Public License, version 2") == {"GPL-2.0-notice"}
    assert names("This work is licensed under the GNU Lesser General Public License, version 3") == set()
    assert names("Licensed under CC BY-NC-SA 4.0") == set() and names("Licensed under CC BY-NC 4.0") == {"CC-BY-NC-4.0-notice"}
    assert names(L.TEMPLATES["GPL-3.0"].replace("version 3", "version 2")) == {"GPL-2.0"}


def test_licenses_with_a_word_inserted_per_line_are_found():
    scanner = L.Scanner(L.TEMPLATES)
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0"):
        words = L.TEMPLATES[name].split()
        for mark in ("REM", "dnl note"):
            text = "Before it.\n" + "\n".join(f"{mark} " + " ".join(words[i : i + 8]) for i in range(1, len(words), 8)) + "\nAfter it."
            found = scanner.scan(text)
            assert [m[0] for m in found] == [name], (name, mark, found)
            assert found[0][1] > 0.9
