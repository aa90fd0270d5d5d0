"""First worksheet of an .xlsx file as rows of text, read with the standard library.

Runs inside Spark tasks, one workbook at a time; see `workbooks.scan_workbooks`.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.parsers import expat

# Number formats of the file format's standard that show a date or a time.
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), 45, 47, *range(50, 59)}

CHUNK = 1 << 18
Row = tuple[int, list[str | None]]


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def parse(archive: zipfile.ZipFile, part: str) -> ElementTree.Element:
    with archive.open(part) as stream:
        return ElementTree.parse(stream).getroot()


def children(element: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [e for e in element.iter() if local(e.tag) == name]


def relations(archive: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    """Relation id -> (kind, part name) of the relations of a part."""
    folder, name = posixpath.split(part)
    found = {}
    for e in children(parse(archive, posixpath.join(folder, "_rels", f"{name}.rels")), "Relationship"):
        target = e.get("Target", "")
        target = target[1:] if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
        found[e.get("Id")] = (posixpath.basename(e.get("Type", "")), target)
    return found


def shows_date(code: str) -> bool:
    """Whether a format code shows a date or time of day (an elapsed `[h]` does not)."""
    if re.search(r"\[(h+|m+|s+)\]", code, re.IGNORECASE):
        return False
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|[\\_*].', "", code.split(";")[0])
    return bool(re.search(r"[dmyhs]", bare, re.IGNORECASE)) and bare.lower() != "general"


def date_styles(archive: zipfile.ZipFile, part: str | None) -> set[int]:
    """Indices of the cell styles whose number format shows a date."""
    if part is None or part not in archive.namelist():
        return set()
    root = parse(archive, part)
    custom = {int(e.get("numFmtId")): shows_date(e.get("formatCode", "")) for e in children(root, "numFmt")}
    formats = [e for group in children(root, "cellXfs") for e in children(group, "xf")]
    ids = [int(e.get("numFmtId", "0")) for e in formats]
    return {i for i, f in enumerate(ids) if custom.get(f, f in DATE_FORMAT_IDS)}


def text_of(element: ElementTree.Element) -> str:
    """Text of a string item; phonetic hints are not part of it."""
    parts = []
    for e in element:
        if local(e.tag) == "t":
            parts.append(e.text or "")
        elif local(e.tag) == "r":
            parts += [t.text or "" for t in e if local(t.tag) == "t"]
    return "".join(parts)


def shared_strings(archive: zipfile.ZipFile, part: str | None) -> list[str]:
    if part is None or part not in archive.namelist():
        return []
    strings = []
    with archive.open(part) as stream:
        for _, e in ElementTree.iterparse(stream):
            if local(e.tag) == "si":
                strings.append(text_of(e))
                e.clear()
    return strings


def date_text(serial: float, epoch_1904: bool) -> str:
    """A date serial as text, to the millisecond; the 1900 calendar counts a day too many
    from March on."""
    if epoch_1904:
        start = datetime(1904, 1, 1)
    else:
        start = datetime(1899, 12, 31) if serial < 60 else datetime(1899, 12, 30)
    moment = start + timedelta(milliseconds=round(serial * 86_400_000))
    if serial < 1:
        return moment.time().isoformat()
    return moment.isoformat(sep=" ")


def column_index(letters: str) -> int:
    index = 0
    for letter in letters.upper():
        index = index * 26 + ord(letter) - 64
    return index - 1


class Workbook:
    """The parts of one workbook that its first worksheet needs."""

    def __init__(self, content: bytes):
        self.archive = zipfile.ZipFile(io.BytesIO(content))
        kinds = {kind: part for kind, part in relations(self.archive, "").values()}
        book_part = kinds["officeDocument"]
        book = parse(self.archive, book_part)
        related = relations(self.archive, book_part)
        sheets = [related[relation_id(s)] for s in children(book, "sheet")]
        self.sheet = next(part for kind, part in sheets if kind == "worksheet")
        self.epoch_1904 = any(e.get("date1904") in ("1", "true") for e in children(book, "workbookPr"))
        by_kind = {kind: part for kind, part in related.values()}
        self.strings = shared_strings(self.archive, by_kind.get("sharedStrings"))
        self.dates = {str(i) for i in date_styles(self.archive, by_kind.get("styles"))}

    def cell_text(self, kind: str, style: str | None, value: str) -> str | None:
        if kind == "n":
            return date_text(float(value), self.epoch_1904) if style in self.dates else value
        if kind == "s":
            return self.strings[int(value)]
        if kind == "e":
            return None
        return value.replace("T", " ") if kind == "d" else value

    def rows(self) -> Iterator[Row]:
        """(zero-based sheet row, cells from the first column on), blank rows left out."""
        done: list[Row] = []
        parser = row_parser(done, self.cell_text)
        with self.archive.open(self.sheet) as stream:
            while chunk := stream.read(CHUNK):
                parser.Parse(chunk, False)
                yield from done
                done.clear()
            parser.Parse(b"", True)


class ShortNames(dict):
    """Tag to its name without a prefix."""

    def __missing__(self, tag: str) -> str:
        return self.setdefault(tag, tag.rpartition(":")[2])


class Columns(dict):
    """Column letters to zero-based positions."""

    def __missing__(self, letters: str) -> int:
        return self.setdefault(letters, column_index(letters))


def row_parser(done: list[Row], cell_text: Callable[[str, str | None, str], str | None]) -> expat.XMLParserType:
    """A parser that appends every row of a worksheet to `done` as soon as it ends.

    Plain parser events on local variables: building an element per cell takes twice as long,
    and this loop is where an import spends most of its Python time.
    """
    parser = expat.ParserCreate()
    parser.buffer_text = True
    names, columns = ShortNames(), Columns()
    row, cells, parts = -1, [], []
    kind, style, column, phonetic = "n", None, 0, False

    def start(tag, attributes):
        nonlocal row, cells, parts, kind, style, column, phonetic
        name = names[tag]
        if name == "v" or name == "t":
            if not phonetic:
                parser.CharacterDataHandler = parts.append
        elif name == "c":
            kind, style = attributes.get("t", "n"), attributes.get("s")
            place = attributes.get("r")
            column = len(cells) if place is None else columns[place.rstrip("0123456789")]
            parts = []
        elif name == "row":
            row = int(attributes["r"]) - 1 if "r" in attributes else row + 1
            cells = []
        elif name == "rPh":
            phonetic = True

    def end(tag):
        nonlocal phonetic
        name = names[tag]
        if name == "v" or name == "t":
            parser.CharacterDataHandler = None
        elif name == "c":
            while len(cells) <= column:
                cells.append(None)
            if parts:
                cells[column] = cell_text(kind, style, "".join(parts))
        elif name == "row":
            if any(cell is not None for cell in cells):
                done.append((row, cells))
        elif name == "rPh":
            phonetic = False

    parser.StartElementHandler, parser.EndElementHandler = start, end
    return parser


def relation_id(sheet: ElementTree.Element) -> str:
    return next(v for k, v in sheet.attrib.items() if local(k) == "id" and k.startswith("{"))


def first_sheet_rows(content: bytes) -> Iterator[Row]:
    return Workbook(content).rows()
