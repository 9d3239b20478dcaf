import pytest

from factloom.functions import notation as n
from pyspark.sql import functions as F

CASES = [
    (n.canonical, {"p.Ala561Val": "A561V", "p.A561V": "A561V", "p.Ala121Leufs*12": "A121fsX", "p.H302fsX339": "H302fsX", "A282fs": "A282fsX", "p.Glu807*": "E807X", "p.C39*": "C39X", "p.Cys108Tyr*": "C108Y", "p.Gly628del": "G628Del", "Y475del": "Y475Del", "a561v": None, "73-73 DEL AAP": "P73Del", "392INSW": "W392Ins", "391DUPS": "S391dup", "Gln1507_Pro1509del": "Q1507_P1509Del", "4944_4945INSH": "4944_4945InsH", "Tyr1795_Glu1796insAsp": "Y1795_E1796InsD", "IVS10+4a>g": "IVS10+4A>G", "c.123_456delAGinsT": "c.123_456delinsT", "deletion of exons 3-5": "del:exon3-5", "del:exon2": "del:exon2", "whole gene deletion": "del:wholegene", "Pro926AlaX14": "P926fsX", None: None}),
    (n.frameshift, {"L987fsX10": "L987fsX", "p.Leu987Profs*10": "L987fsX", "p.Leu987fsTer10": "L987fsX", "987fs": "?987fsX", "fs987": "?987fsX", "A561V": None}),
    (n.nonsense, {"W1001X": "W1001X", "p.Trp1001Ter": "W1001X", "R864stop": "R864X", "Arg864sp": "R864X", "A561V": None}),
    (n.deletion, {"del552": "?552del", "p.Leu552del": "L552del", "L552_L555del": "L552_L555del", "A561V": None}),
    (n.duplication, {"dup552": "?552dup", "p.Leu552dup": "L552dup"}),
    (n.variant_type, {"L987fsX": "frameshift", "W1001X": "nonsense", "L552del": "deletion", "L552dup": "duplication", "G189ins": "insertion", "IVS9+1": "splice", "A561V": "missense", "": "unknown"}),
    (n.short_protein, {"p.Ala561Val": "A561V", "a561v": "A561V", "R176W(het)": "R176W", "p.Asn961=": "N961N", "R864*": "R864X", "Ala193fs*46": "A193fsX", "R864sp": "R864X", "nonsense": None}),
    (n.hgvs_protein, {"A561V": "p.Ala561Val", "A193fsX": "p.Ala193fs*", "G184Del": "p.Gly184del", "R864sp": "p.Arg864*"}),
    (n.tidy, {"p. A561V": "p.A561V", "H302fsX339": "H302fs*339", "c.462_463delAA": "c.462_463del", "c.6638delC": "c.6638del", "c.10delAA": "c.10delAA", "R864X": "R864*", None: ""}),
    (n.cdna, {"c.185A>G": "c.185A>G", "1231A>G": "c.1231A>G", "185delAG": None, "foo": None}),
    (n.position, {"p.Ala561Val": 561, "A561V": 561, "foo": None}),
    (n.exon_event, {"deletion of exons 3-5": "del:exon3-5", "exon 2 duplication": "dup:exon2", "Whole-gene deletion": "del:wholegene"}),
]


@pytest.mark.parametrize("function,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_notation(spark, function, cases):
    rows = spark.createDataFrame([(v,) for v in cases], "v string").select("v", function(F.col("v")).alias("out")).collect()
    assert {r.v: r.out for r in rows} == cases
