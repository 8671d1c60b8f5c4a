"""Which files of a notice are read, and files to texts."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranksieve.functions.names import free_names, quoted

#: Document types in order of preference; the notice itself, then what describes the object, then last resorts.
NOTICE = "Edital"
MAIN = ("Termo de Referência", "Projeto Básico", "Estudo Técnico Preliminar")
LAST = ("DFD", "Minuta do Contrato", "Minuta de Ata de Registro de Preços", "Outros Documentos", "Mapa de Riscos")


def _rank(kind: Column, order: tuple[str, ...]) -> Column:
    out = F.lit(None).cast("int")
    for i, x in reversed(list(enumerate(order))):
        out = F.when(kind == x, F.lit(i)).otherwise(out)
    return out


def main_documents(files: DataFrame, key: str, kind: str) -> DataFrame:
    """All notices and the first main type that a key has; else its first last-resort type; else all its files."""
    per = Window.partitionBy(F.col(quoted(key)))
    n, m, last, has, bm, bl = free_names(files, "n", "m", "l", "has", "bm", "bl")
    of = F.col(quoted(kind))
    out = files.withColumns({n: of == NOTICE, m: _rank(of, MAIN), last: _rank(of, LAST)})
    out = out.withColumns({has: F.coalesce(F.max(n).over(per), F.lit(False)), bm: F.min(m).over(per), bl: F.min(last).over(per)})
    first = F.coalesce(F.col(n), F.lit(False)) | F.coalesce(F.col(m) == F.col(bm), F.lit(False))
    keep = F.when(F.col(has) | F.col(bm).isNotNull(), first).when(F.col(bl).isNotNull(), F.coalesce(F.col(last) == F.col(bl), F.lit(False))).otherwise(F.lit(True))
    return out.where(keep).drop(n, m, last, has, bm, bl)


def active(item: Column, field: str = "statusAtivo") -> Column:
    """A JSON item is active unless it has the field and that is not true."""
    there = F.array_contains(F.json_object_keys(item), field)
    return ~there | F.coalesce(F.get_json_object(item, f"$.{field}") == "true", F.lit(False))


#: What an archive may unpack to, in bytes, and how deep archives may lie in each other.
UNPACKED, DEPTH = 256 << 20, 5


def file_texts(name: str, content: bytes, errors: list[str] | None = None, room: list[int] | None = None, depth: int = 0) -> list[tuple[str, str]]:
    """Texts of a file, by its extension; none for unknown or damaged ones, which ``errors`` names.

    A damaged member of an archive costs its own text alone; beyond UNPACKED bytes or DEPTH an archive is not unpacked.
    """
    errors, room = [] if errors is None else errors, [UNPACKED] if room is None else room
    ext = "." + name.rsplit(".", 1)[-1].lower() if "." in name.rsplit("/", 1)[-1].lstrip(".") else ""
    try:
        if ext == ".txt":
            text = content.decode("utf-8", "ignore")
        elif ext == ".docx":
            w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
            body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{w}body")
            said = lambda p: "".join(t.text or "" for t in p.iter(f"{w}t"))
            text = "\n".join([said(p) for p in body.findall(f"{w}p")] + [said(x) for t in body.findall(f"{w}tbl") for x in t.iter(f"{w}tc")])
        elif ext == ".xlsx":
            s = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
            book = zipfile.ZipFile(io.BytesIO(content))
            shared = []
            if "xl/sharedStrings.xml" in book.namelist():
                shared = ["".join(t.text or "" for t in x.iter(f"{s}t")) for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{s}si")]
            cells = []
            for sheet in sorted(n for n in book.namelist() if n.startswith("xl/worksheets/sheet")):
                for cell in ElementTree.fromstring(book.read(sheet)).iter(f"{s}c"):
                    value = cell.find(f"{s}v")
                    inline = "".join(t.text or "" for t in cell.iter(f"{s}t"))
                    if value is not None and value.text is not None:
                        cells.append(shared[int(value.text)] if cell.get("t") == "s" else value.text)
                    elif inline:
                        cells.append(inline)
            text = "\n".join(cells)
        elif ext == ".pdf":
            from pypdf import PdfReader

            text = "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages)
        elif ext == ".zip":
            if depth >= DEPTH:
                raise ValueError(f"archives lie more than {DEPTH} deep in each other")
            out = []
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for i in z.infolist():
                    if i.is_dir():
                        continue
                    if i.file_size > room[0]:
                        raise ValueError(f"more than {UNPACKED} bytes unpacked")
                    room[0] -= i.file_size
                    try:
                        member = z.read(i)
                    except Exception as e:
                        errors.append(f"{i.filename}: {type(e).__name__}: {e}")
                    else:
                        out += file_texts(i.filename, member, errors, room, depth + 1)
            return out
        else:
            return []
    except Exception as e:  # a damaged file gives no text; others go on
        errors.append(f"{name}: {type(e).__name__}: {e}")
        return []
    return [(name, text)] if text.strip() else []


def _texts(files: DataFrame, name: str, content: str) -> tuple[DataFrame, str]:
    """All columns but the content, and one more, whose name is returned: texts and errors of each file."""
    rest = [x for x in files.columns if x != content]
    (found,) = free_names(files, "found")
    kind = pa.struct([("texts", pa.list_(pa.struct([("name", pa.string()), ("text", pa.string())]))), ("errors", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, contents = b.column(b.schema.get_field_index(name)), b.column(b.schema.get_field_index(content))
            rows = []
            for x, y in zip(names, contents, strict=True):
                errors: list[str] = []
                texts = file_texts(x.as_py() or "", y.as_py() or b"", errors)
                rows.append({"texts": [{"name": n, "text": t} for n, t in texts], "errors": errors})
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(x)) for x in rest), pa.array(rows, kind)], [*rest, found])

    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in files.schema if f.name != content)
    return files.mapInArrow(run, f"{schema}, {quoted(found)} struct<texts:array<struct<name:string,text:string>>,errors:array<string>>"), found


def extract(files: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """All other columns, and text_ord, text_name, text: a row for each text found."""
    out, found = _texts(files, name, content)
    rest = [F.col(quoted(x)) for x in files.columns if x != content]
    (one,) = free_names(out, "one")
    out = out.select(*rest, F.posexplode(f"{quoted(found)}.texts").alias("text_ord", one))
    return out.select(*rest, "text_ord", F.col(one)["name"].alias("text_name"), F.col(one)["text"].alias("text"))


def failures(files: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """All other columns, and erro: a row for each file, or member of an archive, that could not be read."""
    out, found = _texts(files, name, content)
    return out.select(*[F.col(quoted(x)) for x in files.columns if x != content], F.explode(f"{quoted(found)}.errors").alias("erro"))
