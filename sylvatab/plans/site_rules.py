"""Curation knowledge for the 13 sites, as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvatab.plans import rules as k
from sylvatab.plans.rules import Rule, RuleBook
from sylvatab.sources.tables import literal_table

# Site code, site name, latitude, longitude.
SITES = [
    ("bci", "BCI", 9.1543, -79.8461),
    ("fushan", "Fushan", 24.7614, 121.555),
    ("hkk", "HKK", 15.6324, 99.217),
    ("ituri_edoro", "Ituri (Edoro)", 1.4368, 28.5826),
    ("ituri_lenda", "Ituri (Lenda)", 1.4368, 28.5826),
    ("korup", "Korup", 5.0739, 8.8547),
    ("lambir", "Lambir", 4.1865, 114.017),
    ("luquillo", "Luquillo", 18.3262, -65.816),
    ("nanjenshan", "Nanjenshan", 22.056, 120.86),
    ("palanan", "Palanan", 17.0402, 122.388),
    ("pasoh", "Pasoh", 2.982, 102.313),
    ("sinharaja", "Sinharaja", 6.4023, 80.4023),
    ("yasuni", "Yasuni", -0.6859, -76.397),
]

# How names are written at a site.
CASE_RULES = {
    "luquillo": "genus",
    "nanjenshan": "genus",
    "palanan": "genus",
    "pasoh": "lower_genus",
    "sinharaja": "genus",
}

# Patterns of names that do not identify a species (site,
# pattern, looked for among mismatches only). A dot stands for any character.
PATTERNS = [
    ("hkk", "sp.1|cf.", False),
    ("ituri_edoro", "sp1|sp2|sp3|xx", False),
    ("ituri_lenda", "sp1|sp2|sp3|aff.|xx", False),
    ("korup", "sp[[:punct:]]", False),
    (
        "lambir",
        "aff.|cf.|Sp 39|ined.|jvl|incert.|sp. nov.|af.|hairy teeth|Archidendron casai"
        "|Castanopsis nivea|Kayea longipedicellata",
        True,
    ),
    ("luquillo", "X|spp|Â|NA NA", True),
    ("nanjenshan", "_var_| NA", True),
    ("palanan", "cf.", False),
    ("pasoh", "species|ceraina", False),
]

# Accepted names that stand for one taxon counted twice.
DOUBLE_COUNTS = [
    ("hkk", "Casearia grewiifolia Vent."),
    ("ituri_edoro", "Cuviera nigrescens (Elliott ex Oliv.) Wernham"),
    ("ituri_lenda", "Drypetes paxii Hutch."),
    ("korup", "Homalium africanum (Hook.f.) Benth."),
    ("lambir", "Dacryodes incurvata (Engl.) H.J.Lam"),
    ("lambir", "Litsea oppositifolia Gibbs"),
    ("lambir", "Santiria griffithii (Hook.f.) Engl."),
    ("lambir", "Shorea macroptera Dyer"),
    ("lambir", "Shorea scaberrima Burck"),
    ("lambir", "Syzygium garciniifolium (King) Merr. & L.M.Perry"),
    ("lambir", "Syzygium oligomyrum Diels"),
    ("lambir", "Vatica oblongifolia Hook.f."),
    ("palanan", "Ficus variegata Blume"),
    ("palanan", "Diospyros pilosanthera Blanco"),
    ("yasuni", "Miconia elata (Sw.) DC."),
    ("yasuni", "Quiina grandifolia Mildbr."),
]

# Accepted names reached by several synonyms.
SYNONYMS = [
    ("bci", "Piper aequale Vahl"),
    ("ituri_edoro", "Allophylus africanus P.Beauv."),
    ("ituri_edoro", "Englerophytum iturense (Engl.) L.Gaut."),
    ("ituri_edoro", "Phyllocosmus africanus (Hook.f.) Klotzsch"),
    ("ituri_edoro", "Vepris afzelii (Engl.) Mziray"),
    ("ituri_lenda", "Allophylus africanus P.Beauv."),
    ("ituri_lenda", "Pouteria altissima (A.Chev.) Baehni"),
    ("ituri_lenda", "Phyllocosmus africanus (Hook.f.) Klotzsch"),
    ("ituri_lenda", "Sorindeia africana (Engl.) VanDerVeken"),
    ("korup", "Staudtia kamerunensis Warb."),
    ("korup", "Treculia africana Decne. ex Trécul"),
    ("korup", "Zanthoxylum gilletii (DeWild.) P.G.Waterman"),
    ("luquillo", "Myrcia splendens (Sw.) DC."),
    ("palanan", "Xanthophyllum flavescens Roxb."),
    ("yasuni", "Myrciaria floribunda (H.West ex Willd.) O.Berg"),
    ("yasuni", "Tapirira guianensis Aubl."),
]

# Submitted names that are field names or have several readings.
YASUNI_NAMES = """
Bunchosia myrt
Calyptranthes punteada
Eugenia margot
Miconia corine
Piper obglab
Piper obtomen
Acalypha pub
Annona mosaic
Brownea lore
Calyptranthes grancauli
Caryodaphnopsis chica
Chrysochlamys hugo
Chrysophyllum minor
Chrysophyllum tremi
Coccoloba jill
Coccoloba ninfi
Coccoloba papel
Colubrina arbol
Dacryodes gorda
Endlicheria dori
Eschweilera giga
Heisteria grande
Inga 3crasa
Inga 3oscura
Inga 6cuadra
Lacistema med
Licania filo
Licania opaca
Margaritaria roja
Marila comun
Matayba ocho
Maytenus ala
Meliosma doly
Miconia karina
Miconia tipica
Neea aniboid
Neea claudia
Neea garci
Neea gigante
Neea micro
Ocotea luis
Pera duguet
Picramnia mini
Piper bulada
Piper obchic
Piper obvil
Piper renato
Piper sesivil
Plinia unop
Pouteria redondita
Psychotria dracula
Quiina mediana
Randia manolo
Rudgea fina
Sloanea guia
Sloanea oak
Sloanea oppd
Solanum granmini
Talisia 2-retic
Terminalia ob
Tovomita tyana
Guatteria hiena
Zanthoxylum nervi
Zanthoxylum perp
Zanthoxylum suave
Alibertia lance
"""

# Single decisions.
SINGLE_RULES = [
    Rule("lambir", k.PRE_EXCLUDE, "Shorea macroptera subsp. macroptera"),
    Rule("lambir", k.OVERRIDE, "Cinnamomum tahyanum", target="Cinnamomum tahijanum Kosterm."),
    Rule("nanjenshan", k.SENTINEL, "Na NA"),
    *[Rule("korup", k.APPEND, "Unidentified .")] * 10,
    Rule("korup", k.APPEND, "Trichoscypha sp."),
    Rule("ituri_lenda", k.APPEND, "Rinorea unidentified"),
    Rule("pasoh", k.LISTED_UNRESOLVED, "unresolved"),
    Rule("yasuni", k.LISTED_UNRESOLVED, "unresolved"),
    Rule("bci", k.DUPLICATES, "keep"),
    Rule("hkk", k.DUPLICATES, "keep"),
    Rule("bci", k.CODES, "rejoin"),
    Rule("nanjenshan", k.CODES, "rejoin"),
]


def site_rules() -> RuleBook:
    return RuleBook(
        (
            *[Rule(site, k.CASE, mode) for site, mode in CASE_RULES.items()],
            *[Rule(site, k.PATTERN, pattern, only) for site, pattern, only in PATTERNS],
            *[Rule(site, k.DOUBLE_COUNT, name) for site, name in DOUBLE_COUNTS],
            *[Rule(site, k.SYNONYM, name) for site, name in SYNONYMS],
            *[Rule("yasuni", k.NAME, name) for name in YASUNI_NAMES.strip().splitlines()],
            *SINGLE_RULES,
        )
    )


def site_table(spark: SparkSession) -> DataFrame:
    """Site code, name and coordinates."""
    return literal_table(spark, SITES, "site string, Site_name string, Latitude double, Longitude double")
