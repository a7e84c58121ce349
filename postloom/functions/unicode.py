"""Unicode normal forms; Spark has no expression for them, so the few texts that need one go to Python in Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that compatibility composition leaves alone, whatever stands beside them; texts of these only are not sent to Python.
_STABLE = "\\x00-\\x9F¡-§©«-®°±¶·»¿-ıĴ-ľŁ-ňŊ-žΑ-Ωα-ωЀ-џ‐‒-–—-‖‘-’“-”•、-〛ぁ-ゖァ-ヺー一-鿿"


def nfkc(text: Column) -> Column:
    """``text`` in compatibility composition (NFKC); null stays null. Only texts with characters that may change leave the JVM."""

    @F.pandas_udf("string")
    def compose(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))

    return F.coalesce(compose(F.when(text.rlike(f"[^{_STABLE}]"), text)), text)
