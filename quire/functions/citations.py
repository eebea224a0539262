"""Citation formats over a document's columns: author, title, symbol, year, para, url."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import cite_key, escape_tex

_at = lambda para: F.when(para.isNotNull(), F.concat(F.lit(", para. "), para.cast("string"))).otherwise("")


def formats(author: Column, title: Column, symbol: Column, year: Column, para: Column, url: Column) -> dict[str, Column]:
    y = year.cast("string")
    key = cite_key(author, y, para)
    return {
        "un": F.concat(author, F.lit(", "), title, F.lit(", "), symbol, F.lit(" ("), y, F.lit(")"), _at(para)),
        "oscola": F.concat(author, F.lit(", ‘"), title, F.lit("’ ("), y, F.lit(") "), symbol, _at(para)),
        "bluebook": F.concat(author, F.lit(", "), title, F.lit(", U.N. Doc. "), symbol, F.lit(" ("), y, F.lit(")")),
        "mcgill": F.concat(author, F.lit(", "), title, F.lit(", "), symbol, F.lit(", "), y, F.when(para.isNotNull(), F.concat(F.lit(" at para "), para.cast("string"))).otherwise("")),
        "apa": F.concat(author, F.lit(". ("), y, F.lit("). "), title, F.lit(" ("), symbol, F.lit(").")),
        "chicago": F.concat(author, F.lit(". “"), title, F.lit(".” "), symbol, F.lit(", "), y, F.lit(".")),
        "bibtex": F.concat(F.lit("@techreport{"), key, F.lit(", author={"), escape_tex(author), F.lit("}, title={"), escape_tex(title), F.lit("}, number={"), symbol, F.lit("}, year={"), y, F.lit("}}")),
        "ris": F.concat_ws("\n", F.lit("TY  - RPRT"), F.concat(F.lit("AU  - "), author), F.concat(F.lit("TI  - "), title), F.concat(F.lit("PY  - "), y), F.concat(F.lit("M1  - "), symbol), F.lit("ER  - ")),
        "url": url,
    }
