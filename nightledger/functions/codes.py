from pyspark.sql import functions as F


def recode(code, mapping):
    """`code` as text with the mapping applied; codes outside it stay as they are."""
    text = code.cast("string")
    shown = text
    for old, new in mapping.items():
        shown = F.when(text == old, F.lit(new)).otherwise(shown)
    return shown
