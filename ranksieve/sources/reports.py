"""Report sinks: reading report, embedded base document, ranked workbook."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from typing import BinaryIO
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows of a workbook: it is a top-k report, and more is an error.
SHEET_ROWS = 10_000
#: Characters of a main document that the reading report shows.
SHOWN = 1800
RULE = "=" * 90


def reading(items: DataFrame, docs: DataFrame, key: str = "item", shown: int = SHOWN) -> DataFrame:
    """position, key, report: a block of text an item, with the start of each of its main documents.

    ``items``: position, key. ``docs``: key, seq, type, name, text; a null text is one that is not at hand. An item
    without rows in ``docs`` has no listing. Only the shown characters of a text are gathered.
    """
    head = F.concat(F.lit("\n  --- "), F.coalesce("name", F.lit("")), F.lit(" ("), F.length("text").cast("string"), F.lit(" chars extraídos) ---\n  "))
    body = F.concat(head, F.replace(F.substring("text", 1, shown), F.lit("\n"), F.lit("\n  ")))
    part = F.coalesce(body, F.concat(F.lit("  [seq "), F.col("seq").cast("string"), F.lit(" ausente em disco]")))
    named = F.concat(F.lit("("), F.col("seq").cast("string"), F.lit(", '"), F.coalesce("type", F.lit("")), F.lit("')"))
    per = docs.select(key, F.struct("seq", named.alias("named"), part.alias("part")).alias("d")).groupBy(key).agg(F.array_sort(F.collect_list("d")).alias("l"))
    listed = F.concat(F.lit("  documentos principais: ["), F.array_join("l.named", ", "), F.lit("]\n"), F.array_join("l.part", "\n"), F.lit("\n"))
    text = F.concat(F.lit(RULE + "\n"), F.col(key).cast("string"), F.lit("\n" + RULE + "\n"), F.coalesce(listed, F.lit("  [sem documentos listados]")))
    return items.select("position", key).join(per, key, "left").select("position", key, text.alias("report"))


def base_documents(items: DataFrame, model: str, input_type: str, title: str, day: str = "dia", vector: str = "embedding") -> DataFrame:
    """One row an item and a header row a day, as JSON lines: header first (ord -1), then the items by ``ord``.

    A day's items stay rows, so no day has to fit one task; written by day and ord they make the day's file.
    """
    head = items.groupBy(day).agg(F.count(F.lit(1)).alias("quantidade"), F.coalesce(F.max(F.size(vector)), F.lit(0)).alias("dimensao"))
    meta = F.struct(F.lit(title).alias("titulo"), F.lit(model).alias("modelo"), F.lit(input_type).alias("input_type"), "dimensao", F.col(day).alias("data_referencia"), "quantidade")
    header = head.select(F.col(day).alias("dia"), F.lit(-1).cast("long").alias("ord"), F.to_json(F.struct(meta.alias("metadados"))).alias("value"))
    lines = items.select(F.col(day).alias("dia"), F.col("ord").cast("long").alias("ord"), F.to_json(F.struct(*[x for x in items.columns if x not in (day, "ord")]), {"ignoreNullFields": "false"}).alias("value"))
    return header.unionByName(lines)


def _column(number: int) -> str:
    name = ""
    while number:
        number, rest = divmod(number - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(ref: str, value, style: int) -> str:
    if value is None:
        return f'<c r="{ref}" s="{style}"/>'
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f'<c r="{ref}" s="{style}"><v>{value!r}</v></c>'
    text = str(value)
    if style >= 10 and text.startswith("="):
        return f'<c r="{ref}" s="{style - 10}"><f>{escape(text[1:])}</f></c>'
    kept = "".join(ch for ch in text if ch >= " " or ch in "\t\n\r")
    return f'<c r="{ref}" s="{style % 10}" t="inlineStr"><is><t xml:space="preserve">{escape(kept)}</t></is></c>'


_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_PLAIN, _TITLE, _SCORE, _MONEY, _LINK, _BOLD = range(6)
_STYLES = (
    f'{_HEAD}<styleSheet {_NS}><numFmts count="2"><numFmt numFmtId="164" formatCode="0.0000"/><numFmt numFmtId="165" formatCode="&quot;R$&quot;\\ #,##0.00;(&quot;R$&quot;\\ #,##0.00);\\-"/></numFmts>'
    '<fonts count="4"><font><sz val="10"/><name val="Arial"/></font><font><b/><sz val="10"/><color rgb="FFFFFFFF"/><name val="Arial"/></font>'
    '<font><u/><sz val="10"/><color rgb="FF0563C1"/><name val="Arial"/></font><font><b/><sz val="10"/><name val="Arial"/></font></fonts>'
    '<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FF1F4E78"/></patternFill></fill></fills>'
    '<borders count="2"><border/><border><left/><right/><top/><bottom style="thin"><color rgb="FFD9D9D9"/></bottom></border></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="6">'
    + "".join(f'<xf numFmtId="{n}" fontId="{f}" fillId="{p}" borderId="{b}" xfId="0" applyNumberFormat="1" applyFont="1" applyFill="1" applyBorder="1" applyAlignment="1"><alignment vertical="{v}" wrapText="1"/></xf>' for n, f, p, b, v in ((0, 0, 0, 1, "top"), (0, 1, 2, 0, "center"), (164, 0, 0, 1, "top"), (165, 0, 0, 1, "top"), (0, 2, 0, 1, "top"), (0, 3, 0, 0, "top")))
    + "</cellXfs></styleSheet>"
)


def workbook(rows: DataFrame, out: str | BinaryIO, columns: Sequence[tuple[str, str, float, str]], group: str, score: str, sheet: str = "Ranking", summary: str = "Resumo") -> int:
    """Writes ranked rows as a workbook with a summary sheet of formulas; returns the number of rows.

    ``columns``: (column, heading, width, kind), kind one of plain, score, money, link. ``rows`` come in their order, at
    most SHEET_ROWS of them. The summary counts, averages and maximises ``score`` by ``group`` with formulas, so it
    follows edits of the sheet.
    """
    names = [c[0] for c in columns]
    taken = rows.select(*names).limit(SHEET_ROWS + 1).collect()
    if len(taken) > SHEET_ROWS:
        raise ValueError(f"a workbook holds at most {SHEET_ROWS} rows")
    kinds = {"plain": _PLAIN, "score": _SCORE, "money": _MONEY, "link": _LINK}
    cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, (_, _, w, _) in enumerate(columns, 1))
    lines = ['<row r="1" ht="30" customHeight="1">' + "".join(_cell(f"{_column(i)}1", h, _TITLE) for i, (_, h, _, _) in enumerate(columns, 1)) + "</row>"]
    links, rels = [], []
    for r, row in enumerate(taken, 2):
        cells = []
        for i, (name, _, _, kind) in enumerate(columns, 1):
            ref, value = f"{_column(i)}{r}", row[name]
            cells.append(_cell(ref, value, kinds[kind] if kind != "link" or value else _PLAIN))
            if kind == "link" and value:
                links.append(f'<hyperlink ref="{ref}" r:id="rId{len(links) + 1}"/>')
                rels.append(f'<Relationship Id="rId{len(links)}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/hyperlink" Target={quoteattr(str(value))} TargetMode="External"/>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    last = _column(len(columns))
    ranked = (
        f'{_HEAD}<worksheet {_NS}><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
        f'<cols>{cols}</cols><sheetData>{"".join(lines)}</sheetData><autoFilter ref="A1:{last}{len(taken) + 1}"/>'
        + (f"<hyperlinks>{''.join(links)}</hyperlinks>" if links else "")
        + "</worksheet>"
    )
    g, s = _column(names.index(group) + 1), _column(names.index(score) + 1)
    at = "'" + sheet.replace("'", "''") + "'"
    found = sorted({str(row[group]) for row in taken if row[group] is not None})
    lines = ['<row r="1">' + "".join(_cell(f"{_column(i)}1", h, _TITLE) for i, h in enumerate(("Grupo", "Quantidade", "Score médio", "Score máximo"), 1)) + "</row>"]
    for r, name in enumerate(found, 2):
        formulas = (f"=COUNTIF({at}!{g}:{g},A{r})", f'=IFERROR(AVERAGEIF({at}!{g}:{g},A{r},{at}!{s}:{s}),"-")', f'=IFERROR(_xlfn.MAXIFS({at}!{s}:{s},{at}!{g}:{g},A{r}),"-")')
        styles = (_PLAIN, _SCORE, _SCORE)
        lines.append(f'<row r="{r}">' + _cell(f"A{r}", name, _PLAIN) + "".join(_cell(f"{_column(i)}{r}", f, 10 + k) for i, (f, k) in enumerate(zip(formulas, styles), 2)) + "</row>")
    total = len(found) + 2
    lines.append(f'<row r="{total}">' + _cell(f"A{total}", "Total", _BOLD) + _cell(f"B{total}", f"=SUM(B2:B{total - 1})" if found else 0, 10 + _BOLD if found else _BOLD) + "</row>")
    widths = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate((34, 16, 14, 14), 1))
    summed = f'{_HEAD}<worksheet {_NS}><cols>{widths}</cols><sheetData>{"".join(lines)}</sheetData></worksheet>'
    rel = "http://schemas.openxmlformats.org/package/2006/relationships"
    kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{main}.worksheet+xml"/><Override PartName="/xl/worksheets/sheet2.xml" ContentType="{main}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{main}.styles+xml"/></Types>',
        "_rels/.rels": f'{_HEAD}<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{_HEAD}<workbook {_NS}><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/><sheet name={quoteattr(summary)} sheetId="2" r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{_HEAD}<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{kind}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{kind}/worksheet" Target="worksheets/sheet2.xml"/><Relationship Id="rId3" Type="{kind}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": _STYLES,
        "xl/worksheets/sheet1.xml": ranked,
        "xl/worksheets/sheet2.xml": summed,
    }
    if rels:
        parts["xl/worksheets/_rels/sheet1.xml.rels"] = f'{_HEAD}<Relationships xmlns="{rel}">{"".join(rels)}</Relationships>'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return len(taken)
