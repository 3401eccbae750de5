"""A small collection for trying the layers without a network: five records, their texts and minimal PDF files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BODY = (
    "A biblioteca organiza cada acervo com uma nova pesquisa e não perde os dados da coleção antiga, que ao longo do tempo foram reunidos em parte pela equipe. "
    "O estudo foi escrito por Ana Lima Duarte e enviado a leitora@correio.example, com telefone (61) 91234-5678 e documento 123.456.789-00. "
)
PORTUGUESE = "1 INTRODUÇÃO\n" + _BODY * 2 + " ".join(f"O capítulo {n} não repete a leitura{n} e traz uma nota{n} com outra fonte{n}." for n in range(12)) + "\nREFERÊNCIAS\nobras"
ENGLISH = "The library keeps all of the old books and the new survey is made with the data of each reader. " * 8
_SCHEMA = (
    "bdtd_id string, status string, metadata struct<title string, authors array<string>, date string>, raw_record struct<orientador string>, text string"
)


def records(spark: SparkSession) -> DataFrame:
    """Records with their texts: complete, its copy under another title, too short, in another language, and not downloaded."""
    rows = [
        ("fixture-a", "downloaded", ("Acervos", ["Duarte, Ana Lima", "Ana Lima Duarte"], "2020"), ("Rui Prado Sena",), PORTUGUESE),
        ("fixture-b", "downloaded", ("Outros acervos", ["Bia Sousa"], "2021"), (None,), PORTUGUESE + " e mais obras"),
        ("fixture-c", "downloaded", ("Curto", None, None), (None,), "x"),
        ("fixture-d", "downloaded", ("Libraries", [], "2019"), (None,), ENGLISH),
        ("fixture-e", "restricted", ("Fechado", None, ""), (None,), None),
    ]
    return spark.createDataFrame(rows, _SCHEMA)


def minimal_pdf(text: str) -> bytes:
    """A PDF file of one page that shows the text in lines."""
    shown = "".join(f"({line}) Tj T* " for line in text.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)").split("\n"))
    stream = f"BT /F1 10 Tf 12 TL 40 800 Td {shown}ET".encode("latin-1", "replace")
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 595 842] /Contents 4 0 R /Resources << /Font << /F1 5 0 R >> >> >>",
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(stream), stream), b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>",
    ]
    out, places = b"%PDF-1.4\n", []
    for n, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    table = b"".join(b"%010d 00000 n \n" % p for p in places)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, table, len(objects) + 1, len(out))
