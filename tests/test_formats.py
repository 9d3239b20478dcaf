"""Article XML as text: nothing that is said outside skipped elements is lost, and blocks stay blocks."""

import random
import re
import xml.etree.ElementTree as ET

from factloom.sources import formats


def test_blocks_within_sections_and_paragraphs():
    source = b"""<article><front><journal-meta>skipped</journal-meta><article-id>1</article-id><title-group><article-title>On <i>things</i></article-title></title-group></front>
    <body><sec><title>Results</title><p>First <b>words</b>, then <list><list-item>Bare item <b>x</b></list-item><list-item><p>two</p></list-item></list> the rest.</p>
    <disp-quote>Quoted words</disp-quote><preformat>pre</preformat><p>Before <table-wrap><label>Table 1</label><caption><title>Seen</title></caption><table><tr><td>A1V</td><td>3</td></tr><tr><td>B</td></tr></table></table-wrap> behind</p>
    loose text<unknown>odd <sub>2</sub></unknown></sec></body><back><ref-list><ref>not this</ref></ref-list></back></article>"""
    assert formats.xml_text(source).split("\n\n") == [
        "# On things", "## Results", "First words, then", "Bare item x", "two", "the rest.", "Quoted words", "pre", "Before", "Table 1", "## Seen",
        "| A1V | 3 |\n| --- | --- |\n| B |  |", "behind", "loose text", "odd 2",
    ]


def words(element):
    out = [element.text or ""]
    for child in element:
        name = formats._name(child)
        if name not in formats.SKIPPED and name not in formats.IDENTIFIERS:
            out += words(child)
        out.append(child.tail or "")
    return out


def test_every_character_is_there():
    rng = random.Random(4)
    names = ["p", "sec", "title", "b", "list", "list-item", "table-wrap", "table", "tr", "td", "caption", "disp-quote", "odd", "math", "fn", "x", "article-id", "ref-list", "fig", "body"]

    def grow(depth):
        e = ET.Element(rng.choice(names))
        e.text = rng.choice(["", " ", f"w{rng.randrange(10**6)} "])
        for _ in range(rng.randrange(4) if depth < 5 else 0):
            child = grow(depth + 1)
            child.tail = rng.choice(["", f" t{rng.randrange(10**6)}"])
            e.append(child)
        return e

    for _ in range(400):
        root = ET.Element("article")
        root.extend([grow(0) for _ in range(3)])
        said = formats.xml_text(ET.tostring(root))
        found, expected = (sorted(re.findall(r"[wt]\d+", "".join(x))) for x in (said, words(root)))
        assert found == expected
