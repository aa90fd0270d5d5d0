"""Write small .xlsx files with the standard library."""

import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"

UNITS = ["NO.", "Time", "degC", "%", "W/m2", "lux", "degC"]


def letters(index):
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def serial(moment, epoch=datetime(1899, 12, 30)):
    span = moment - epoch
    return span.days + span.seconds / 86400


class Sheet:
    """Cells as (row, column, value); a datetime is stored as a styled serial."""

    def __init__(self, rows, shared=True, epoch=datetime(1899, 12, 30), references=True):
        self.rows, self.shared, self.epoch, self.references = rows, shared, epoch, references

    def xml(self, strings):
        parts = [f'<worksheet xmlns="{MAIN}"><sheetData>']
        for number, cells in self.rows:
            parts.append(f'<row r="{number + 1}">' if self.references else "<row>")
            for column, value in enumerate(cells):
                if value is None and self.references:
                    continue
                parts.append(self.cell(number, column, value, strings))
            parts.append("</row>")
        parts.append("</sheetData></worksheet>")
        return "".join(parts)

    def cell(self, number, column, value, strings):
        at = f' r="{letters(column)}{number + 1}"' if self.references else ""
        if value is None:
            return f"<c{at}/>"
        if isinstance(value, datetime):
            return f'<c{at} s="1"><v>{serial(value, self.epoch)!r}</v></c>'
        if isinstance(value, tuple):
            return f'<c{at} t="{value[0]}"><v>{value[1]}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c{at}><v>{value!r}</v></c>"
        if self.shared:
            strings.append(value)
            return f'<c{at} t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c{at} t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def write_xlsx(path, sheets, epoch_1904=False, format_code="yyyy/mm/dd hh:mm:ss"):
    """`sheets` in workbook order; parts are numbered backwards on purpose."""
    strings = []
    count = len(sheets)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(
            "_rels/.rels",
            f'<Relationships xmlns="{PACKAGE}"><Relationship Id="r1" Type="{REL}/officeDocument"'
            ' Target="xl/workbook.xml"/></Relationships>',
        )
        entries = "".join(f'<sheet name="s{i}" sheetId="{i + 1}" r:id="rs{i}"/>' for i in range(count))
        archive.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><workbookPr date1904="{int(epoch_1904)}"/>'
            f"<sheets>{entries}</sheets></workbook>",
        )
        for i, sheet in enumerate(sheets):
            archive.writestr(f"xl/worksheets/sheet{count - i}.xml", sheet.xml(strings))
        related = "".join(
            f'<Relationship Id="rs{i}" Type="{REL}/worksheet" Target="worksheets/sheet{count - i}.xml"/>'
            for i in range(count)
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE}">{related}'
            f'<Relationship Id="x1" Type="{REL}/sharedStrings" Target="/xl/sharedStrings.xml"/>'
            f'<Relationship Id="x2" Type="{REL}/styles" Target="styles.xml"/></Relationships>',
        )
        items = "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in strings)
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        archive.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="170" formatCode="{escape(format_code)}"/></numFmts>'
            '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>',
        )


def logger_rows(samples, units=UNITS, preamble=2):
    """A logger sheet: preamble, marker, field names, units, samples."""
    rows = [(i, ["Model", f"line {i}"]) for i in range(preamble)]
    names = ["Number", "Date&Time", *[f"CH{i}" for i in range(1, len(units) - 1)]]
    rows += [(preamble, ["Data"]), (preamble + 1, names), (preamble + 2, units)]
    return rows + [(preamble + 3 + i, [i + 1, *sample]) for i, sample in enumerate(samples)]


def write_logger(folder, name, samples, **kwargs):
    write_xlsx(f"{folder}/{name}", [Sheet(logger_rows(samples, **kwargs))])
