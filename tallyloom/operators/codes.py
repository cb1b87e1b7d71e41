"""Display classes of codes: a small relation of fixed values, looked up by scheme and code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Which edition of the schemes the values belong to; a later one adds its own under another key.
EDITION = "2023"
#: Colours of codes, by edition and scheme, in their order. 99 stands for no data.
COLOURS = {
    EDITION: {
        "oac": {
            "1": "#ccbb99", "1a": "#ccbb99", "1b": "#e4d3b1", "1c": "#ffeecc", "2": "#4daf4a", "2a": "#2d7f2a", "2b": "#4daf4a", "2c": "#8def8a",
            "3": "#ff0000", "3a": "#ff0000", "3b": "#cc0000", "3c": "#990000", "4": "#f781bf", "4a": "#f781bf", "4b": "#f761af", "4c": "#f7419f",
            "5": "#ff7f00", "5a": "#ff7f00", "5b": "#ffaf00", "6": "#ffcb1f", "6a": "#ffcb1f", "6b": "#cc9b1f", "6c": "#996b1f",
            "7": "#377eff", "7a": "#377eff", "7b": "#77aeff", "8": "#984ea3", "8a": "#984ea3", "8b": "#b784bf", "99": "#dddddd",
        },
        "loac": {
            "A": "#66C2A5", "A1": "#539B84", "A2": "#97C3B5", "A3": "#C5FFEC", "B": "#FC8D62", "B1": "#CA714E", "B2": "#FC9872", "C": "#8DA0CB", "C1": "#63708E", "C2": "#C6D0E5",
            "D": "#E78AC3", "D1": "#B96E9C", "D2": "#EEADD5", "D3": "#FFB9DA", "E": "#A6D854", "E1": "#74973B", "E2": "#CAE898", "F": "#FFD92F", "F1": "#CCAE26", "F2": "#FFE882",
            "G": "#D9dddf", "G1": "#7D7D7D", "G2": "#D1D1D1", "99": "#dddddd",
        },
        "iuc": {
            "1": "#ea4d78", "2": "#f36d5a", "3": "#e4a5d0", "4": "#ffd39b", "5": "#a5cfbc", "6": "#d2d1ab", "7": "#79cdcd", "8": "#dd7cdc", "9": "#808fee", "10": "#8470ff", "99": "#dddddd",
        },
        "eee": {
            "1": "#fccde5", "2": "#b3de69", "3": "#fdb462", "4": "#ffffb3", "5": "#bebada", "6": "#fb8072", "7": "#80b1d3", "8": "#8dd3c7", "9": "#d9d9d9", "99": "#d9d9d9",
        },
        "ahah": {
            "1": "#F46D43", "2": "#F68A5B", "3": "#F8A774", "4": "#FAC48D", "5": "#FCE1A6", "6": "#FFFFBF", "7": "#D0DCBC", "8": "#A2BAB9", "9": "#7397B6", "10": "#4575B4",
        },
        "imd": {
            "1": "#a50026", "2": "#d73027", "3": "#f46d43", "4": "#fdae61", "5": "#fee08b", "6": "#d9ef8b", "7": "#a6d96a", "8": "#66bd63", "9": "#1a9850", "10": "#006837",
        },
        "bbs": {
            "1": "#276419", "2": "#4d9221", "3": "#7fbc41", "4": "#b8e186", "5": "#e6f5d0", "6": "#fde0ef", "7": "#f1b6da", "8": "#de77ae", "9": "#c51b7d", "10": "#8e0152",
        },
    }
}
#: Schemes whose codes are a group and a letter or digit of its own.
NESTED = ("oac", "loac")


def colours(spark: SparkSession, edition: str = EDITION) -> DataFrame:
    """(scheme, code, colour) of an edition."""
    rows = [(scheme, code, colour) for scheme, codes in COLOURS[edition].items() for code, colour in codes.items()]
    return spark.createDataFrame(rows, "scheme string, code string, colour string")


def coloured(rows: DataFrame, scheme: Column, code: Column, edition: str = EDITION) -> DataFrame:
    """rows with `colour` and `matched`: code, group (a nested code whose own is not known takes its group's colour) or
    none, where the colour is null. Codes are compared as text, so numbers do as well."""
    given = code.cast("string")
    asked = rows.select(F.struct("*").alias("row"), scheme.alias("scheme"), given.alias("code"), F.when(scheme.isin(*NESTED) & (given != "99"), F.substring(given, 1, 1)).alias("group"))
    known = colours(rows.sparkSession, edition)
    own = F.broadcast(known.select("scheme", "code", F.col("colour").alias("own")))
    wide = F.broadcast(known.select("scheme", F.col("code").alias("group"), F.col("colour").alias("wide")))
    met = asked.join(own, ["scheme", "code"], "left").join(wide, ["scheme", "group"], "left")
    matched = F.when(F.col("own").isNotNull(), "code").when(F.col("wide").isNotNull(), "group").otherwise("none")
    return met.select("row.*", F.coalesce("own", "wide").alias("colour"), matched.alias("matched"))
