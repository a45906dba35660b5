"""Vocabularies that results must agree with, as published."""

#: Warning levels.
WARNINGS = ("NIL", "ALERT", "HIGH ALERT", "WARNING", "DANGER")
#: Region codes by the spellings in use.
REGIONS = {
    "SG": "SG", "SOUTH GUJARAT": "SG",
    "NG": "NG", "NORTH GUJARAT": "NG",
    "CG": "CG", "CENTRAL GUJARAT": "CG",
    "SAU": "Sau", "SAURASHTRA": "Sau",
    "KUTCH": "Kutch", "KACHCHH": "Kutch",
}
#: District names by key; an open vocabulary.
DISTRICTS = {
    "surendranagar": "Surendranagar",
    "devbhumidwarka": "Devbhumi Dwarka",
    "dbdwarka": "Devbhumi Dwarka",
    "devbhumi": "Devbhumi Dwarka",
    "chhotaudepur": "Chhotaudepur",
    "aravalli": "Arvalli",
    "arvalli": "Arvalli",
    "mehsana": "Mahesana",
    "mahesana": "Mahesana",
    "girsomnath": "Gir Somnath",
    "banaskantha": "Banaskantha",
    "sabarkantha": "Sabarkantha",
    "panchmahal": "Panchmahal",
    "panchmahals": "Panchmahal",
}
#: Words of a dam's name that tell nothing.
NOISE_WORDS = ("dam", "tank", "reservoir", "project", "weir", "scheme", "irrigation", "stg", "stage")
#: Spellings of one sound, in the order in which they are replaced.
SOUNDS = (
    ("chh", "c"), ("ch", "c"), ("shh", "s"), ("sh", "s"), ("ph", "f"),
    ("th", "t"), ("dh", "d"), ("bh", "b"), ("gh", "g"), ("kh", "k"),
    ("jh", "j"), ("w", "v"), ("y", "i"), ("ee", "i"), ("oo", "u"),
    ("aa", "a"), ("z", "j"), ("q", "k"), ("x", "ks"),
)
#: Parents of districts, by the spellings of older pages.
PARENT_DISTRICTS = {
    "kachchh": "kutch", "mahesana": "mehsana", "panchamahal": "panchmahal",
    "panch mahals": "panchmahal", "vadodra": "vadodara",
    "chhotaudepur": "chhota udepur", "chota udeypur": "chhota udepur",
    "devbhumi dwarka": "jamnagar", "devbhoomi dwarka": "jamnagar",
    "gir somnath": "junagadh", "morbi": "rajkot", "botad": "bhavnagar",
    "mahisagar": "panchmahal", "arvalli": "sabarkantha",
    "aravalli": "sabarkantha", "sabar kantha": "sabarkantha",
    "banas kantha": "banaskantha", "ahmadabad": "ahmedabad",
    "dohad": "dahod", "surendra nagar": "surendranagar",
}
