import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = ("key", "size", "shard", "slot", "h", "v", "fp", "row", "version", "spans", "kept", "score", "word", "n",
           "lang_pred", "held_out", "root", "rep", "stratum", "fold", "good", "label")

PLAIN = ("The river runs past the old mill and the children of the village watch how the water turns the wheel "
         "every morning before school, while their parents talk about the weather, the harvest and the news.")
GERMAN = ("Der Fluss läuft an der alten Mühle vorbei, und die Kinder des Dorfes sehen jeden Morgen vor der Schule zu, "
          "wie das Wasser das Rad dreht, während ihre Eltern über das Wetter, die Ernte und die Nachrichten reden.")
FRENCH = ("La rivière passe devant le vieux moulin et les enfants du village regardent chaque matin avant l'école "
          "comment l'eau fait tourner la roue, pendant que leurs parents parlent du temps, de la récolte et des nouvelles.")


@pytest.fixture(scope="session")
def edge_rows():
    long_text = " ".join(f"word{i % 997} {PLAIN[i % 60:i % 60 + 9]}" for i in range(40_000))
    rows = [
        (1, PLAIN, "en", "a", 10), (2, None, "en", "a", None), (3, "", "de", None, 0), (4, " \n\t  \x0b", None, "b", 5),
        (5, PLAIN, "en", "a", 10), (1, PLAIN, "en", "a", 10), (6, GERMAN, "de", "a", 3), (7, FRENCH, "fr", "a", 3),
        (8, PLAIN + " More at end.", None, None, None), (9, "12 34 !!! 56", "en", "c", 12), (10, long_text, "en", "c", 1),
        (11, PLAIN + "\n" + PLAIN + "\n" + PLAIN, "en", "c", 1), (12, "é😀 漢字 <|endoftext|> x\xa0 y ١", "fr", "c", 1),
        (13, "a" * 30_000, "en", "c", 1), (14, "Write to ann.b@mail.example.com or +1 (555) 555-1234, card 4111 1111 1111 1111, "
             "host 10.0.0.255.", "en", "c", 1), (15, "Der " * 400, "de", "c", 1),
        (None, GERMAN + " Ohne Nummer.", "de", "a", 1), (None, None, None, None, None),
    ]
    rows += [(100 + i, f"{PLAIN if i % 3 else GERMAN} Nummer {i} von {i * 7}.", "en" if i % 3 else "de", "d", 1) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """Documents with every odd case, and columns named like the operators'."""
    from pyspark.sql import functions as F
    d = spark.createDataFrame(edge_rows, SCHEMA)
    return d.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
