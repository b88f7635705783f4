"""Word lists that decide results.  They are part of the data model, not of this design."""

from __future__ import annotations

#: Legal forms dropped from a name's core (fixed value).
LEGAL = "inc incorporated corp corporation llc ltd limited pvt private co company".split()
#: Further legal forms dropped after transliteration (fixed value).
ROMAN_LEGAL = [*LEGAL, *"praivet preivet praivett pra li llp pllc".split()]
#: Legal and domain words dropped from canonical names (fixed value).
CANONICAL_LEGAL = "sa sarl sas sasu eurl sci com net org".split()
#: Legal forms that do not tell French references apart (fixed value).
FRENCH_LEGAL = "sa sarl sas sasu eurl sci".split()
#: Address abbreviations (fixed value).
ABBREVIATIONS = {"street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "apartment": "apt", "suite": "ste"}
#: Address words too common for number-and-word keys (fixed value).
KEY_STOP = "null floor near india opposite building".split()
#: Address words too common for word keys (fixed value).
WORD_STOP = "null floor near india opposite building street road avenue block nagar delhi mumbai chennai kolkata bangalore private limited".split()
#: Consonants that sound alike, one string onto the other (fixed value).
SOUND_FROM, SOUND_TO = "vwpdgqcz", "bbftkkks"
#: State names and codes (fixed value).
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de", "district of columbia": "dc", "florida": "fl",
    "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj",
    "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc",
    "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
INDIA_STATES = {
    "andhra pradesh": "ap", "arunachal pradesh": "ar", "assam": "as", "bihar": "br", "chhattisgarh": "ct", "goa": "ga", "gujarat": "gj", "haryana": "hr", "himachal pradesh": "hp", "jharkhand": "jh",
    "karnataka": "ka", "kerala": "kl", "madhya pradesh": "mp", "maharashtra": "mh", "maharastra": "mh", "manipur": "mn", "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl", "odisha": "od",
    "orissa": "od", "punjab": "pb", "rajasthan": "rj", "sikkim": "sk", "tamil nadu": "tn", "tamilnadu": "tn", "telangana": "tg", "tripura": "tr", "uttar pradesh": "up", "uttarakhand": "ut",
    "uttaranchal": "ut", "west bengal": "wb", "delhi": "dl",
}
STATES = {"us": US_STATES, "india": INDIA_STATES}
#: Latin letters without a decomposition, and the letters of Cyrillic and Greek, in their usual spelling (fixed values).
LATIN_SPELLING = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i"}
CYRILLIC_SPELLING = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
GREEK_SPELLING = {
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s",
    "τ": "t", "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps", "ω": "o",
}
#: First code points of the Indic blocks whose letters stand at the same places as those of Devanagari (fixed values).
DEVANAGARI, INDIC = 0x900, [0x980, 0xA00, 0xA80, 0xB00, 0xB80, 0xC00, 0xC80, 0xD00]
