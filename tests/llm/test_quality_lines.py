"""Lines with their verdicts, by hand, in the table's languages."""

import pytest
from pyspark.sql import functions as F

from marketlake.llm import quality_rules

FRENCH = "Le marché du matin, dit-elle, « sent le pain chaud » et « la pluie », comme autrefois « chez nous ». " * 4
MARKDOWN = "The **first** rule is that a > b holds when x > y, and the **second** rule says p > q is not needed for any of the other cases. " * 2
LONG = "word " * 399
LINES = {
    "The weather was fine on that day.": True,
    "Das Wetter war an diesem Tag gut, und die Leute gingen hinaus.": True,
    "Il faisait beau ce jour-là ; les gens sortaient.": True,
    "Hacía buen tiempo aquel día. ¿Y la gente? ¡Salió!": True,
    FRENCH: True,
    MARKDOWN: True,
    "He said \"stop!\" and left": True,
    "He said \"stop!\" and she left.": True,
    "Really?! No way!! She said so, and everybody in the small town heard it twice before the end of that very long and quiet day, did they not?!": True,
    "Buy!! Now!! Cheap!! Today.": False,
    "Home | Products | About | Contact.": False,
    "Home > Shoes > Boots > Winter.": False,
    "Start • Produkte • Kontakt • Impressum.": False,
    "## $$ ** && win.": False,
    LONG + "end. x": False,
    ("word " * 50 + "end. ") * 8: True,
    "All rights reserved.": False,
    "Tous droits réservés.": False,
    "Alle Rechte vorbehalten.": False,
    "Todos los derechos reservados.": False,
    "Please read our privacy policy.": False,
    "no end at all": False,
    "": False,
}


def test_lines_by_hand(spark):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(LINES)], "k int, line string").repartition(3)
    got = {r["k"]: r["passes"] for r in rows.select("k", quality_rules.line_passes(F.col("line")).alias("passes")).collect()}
    assert {x: got[k] for k, x in enumerate(LINES)} == LINES


@pytest.mark.parametrize("text", [FRENCH, MARKDOWN, (FRENCH + "\n") * 2])
def test_clean_documents_of_one_line_are_kept(spark, text):
    docs = spark.createDataFrame([(1, text.replace("« chez nous »", "« chez nous » ") + " ".join(f"Wort{k} ist hier." for k in range(60)))], "doc_id long, text string")
    got = quality_rules.clean_lines(docs).first()
    assert got["kept_chars"] == got["word_chars"] and got["kept"] == (not got["base_failed"])
