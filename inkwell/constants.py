"""Fixed values of the domain. They must equal the published ones for right results."""

from __future__ import annotations

#: Words that say nothing in a journal's title.
TITLE_STOPWORDS = (
    "revista", "de", "del", "la", "las", "los", "el", "en", "y", "e",
    "journal", "of", "the", "and", "for", "in", "on", "a", "an",
    "international", "review", "annals", "proceedings", "bulletin",
    "research", "studies", "transactions", "cuadernos", "boletin", "acta", "actas",
)

#: Stopwords and suffixes of the light stemmer; suffixes by priority.
STOPWORDS_ES = ("a", "al", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "para", "por", "que", "se", "su", "un", "una", "y")
STOPWORDS_EN = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")
SUFFIXES_ES = ("amientos", "imientos", "aciones", "mente", "ando", "iendo", "es", "os", "as")
SUFFIXES_EN = ("ization", "ations", "ingly", "edly", "ing", "ed", "es", "s")

#: Ordinals of national categories and of quartiles; 0 is unknown.
CATEGORY_ORDINAL = {"A1": 4, "A2": 3, "B": 2, "C": 1}
QUARTILE_ORDINAL = {"Q1": 4, "Q2": 3, "Q3": 2, "Q4": 1}

#: Matching threshold, outlier factor, fast-publishing limit in weeks, weeks in a month.
FUZZY_THRESHOLD = 85.0
IQR_FACTOR = 3.0
FAST_WEEKS = 12
WEEKS_PER_MONTH = 4.345

#: Price levels relative to the USA; other countries have 1.
PPP_FACTORS = {
    "CO": 0.38, "BR": 0.45, "MX": 0.48, "AR": 0.35, "CL": 0.60, "PE": 0.42, "ES": 0.78, "US": 1.00, "GB": 0.95, "DE": 0.88,
    "NL": 0.92, "CH": 1.25, "FR": 0.89, "IT": 0.80, "PT": 0.68, "CA": 0.90, "AU": 0.93, "CN": 0.52, "IN": 0.28, "ZA": 0.44,
}

#: Countries of low and middle income, whose authors may get waivers.
LMIC = (
    "AF", "AL", "DZ", "AO", "AR", "AM", "AZ", "BD", "BY", "BZ", "BJ", "BT", "BO", "BA", "BW", "BR", "BG", "BF", "BI", "CV", "KH", "CM", "CF", "TD",
    "CN", "CO", "KM", "CG", "CD", "CR", "CI", "CU", "DJ", "DM", "DO", "EC", "EG", "SV", "GQ", "ER", "ET", "FJ", "GA", "GM", "GE", "GH", "GD", "GT",
    "GN", "GW", "GY", "HT", "HN", "IN", "ID", "IR", "IQ", "JM", "JO", "KZ", "KE", "KI", "KP", "XK", "KG", "LA", "LB", "LS", "LR", "LY", "MG", "MW",
    "MY", "MV", "ML", "MH", "MR", "MU", "MX", "FM", "MD", "MN", "ME", "MA", "MZ", "MM", "NA", "NP", "NI", "NE", "NG", "MK", "PK", "PW", "PA", "PG",
    "PY", "PE", "PH", "RU", "RW", "WS", "ST", "SN", "RS", "SL", "SB", "SO", "ZA", "SS", "LK", "LC", "VC", "SD", "SR", "SY", "TJ", "TZ", "TH", "TL",
    "TG", "TO", "TN", "TR", "TM", "TV", "UG", "UA", "UZ", "VU", "VE", "VN", "PS", "YE", "ZM", "ZW",
)

#: Country names, without accents, to ISO 3166-1 alpha-2.
COUNTRY_ISO = {
    "colombia": "CO", "brazil": "BR", "brasil": "BR", "mexico": "MX", "argentina": "AR", "chile": "CL", "peru": "PE", "spain": "ES",
    "united states": "US", "united states of america": "US", "usa": "US", "united kingdom": "GB", "uk": "GB", "germany": "DE", "alemania": "DE",
    "france": "FR", "francia": "FR", "italy": "IT", "italia": "IT", "netherlands": "NL", "paises bajos": "NL", "switzerland": "CH", "suiza": "CH",
    "portugal": "PT", "ecuador": "EC", "venezuela": "VE", "cuba": "CU", "costa rica": "CR", "uruguay": "UY", "paraguay": "PY", "bolivia": "BO",
    "panama": "PA", "guatemala": "GT", "honduras": "HN", "el salvador": "SV", "nicaragua": "NI", "dominican republic": "DO", "republica dominicana": "DO",
    "puerto rico": "PR", "canada": "CA", "australia": "AU", "china": "CN", "japan": "JP", "south korea": "KR", "corea del sur": "KR", "india": "IN",
    "russia": "RU", "rusia": "RU", "turkey": "TR", "iran": "IR", "egypt": "EG", "egipto": "EG", "south africa": "ZA", "nigeria": "NG", "kenya": "KE",
    "slovenia": "SI", "eslovenia": "SI", "croatia": "HR", "croacia": "HR", "czech republic": "CZ", "republica checa": "CZ", "poland": "PL", "polonia": "PL",
    "romania": "RO", "hungary": "HU", "austria": "AT", "sweden": "SE", "suecia": "SE", "norway": "NO", "noruega": "NO", "denmark": "DK", "dinamarca": "DK",
    "finland": "FI", "finlandia": "FI", "ireland": "IE", "irlanda": "IE", "belgium": "BE", "new zealand": "NZ", "nueva zelanda": "NZ", "singapore": "SG",
    "singapur": "SG", "malaysia": "MY", "malasia": "MY", "thailand": "TH", "tailandia": "TH", "indonesia": "ID", "philippines": "PH", "filipinas": "PH",
    "pakistan": "PK", "bangladesh": "BD", "sri lanka": "LK", "taiwan": "TW", "hong kong": "HK", "saudi arabia": "SA", "arabia saudita": "SA",
    "united arab emirates": "AE", "israel": "IL", "ukraine": "UA", "ucrania": "UA", "greece": "GR", "grecia": "GR", "bulgaria": "BG", "serbia": "RS",
    "slovakia": "SK", "eslovaquia": "SK", "lithuania": "LT", "lituania": "LT", "latvia": "LV", "letonia": "LV", "estonia": "EE", "iceland": "IS",
    "islandia": "IS", "luxembourg": "LU", "luxemburgo": "LU", "malta": "MT", "cyprus": "CY", "chipre": "CY",
}

#: Reference rates to US dollars of the pipeline.
USD_RATES = {
    "USD": 1.0, "EUR": 1.08, "GBP": 1.27, "CHF": 1.13, "JPY": 0.0067, "CAD": 0.74, "AUD": 0.65, "BRL": 0.20, "MXN": 0.058, "COP": 0.00024,
    "ARS": 0.0011, "CLP": 0.0011, "PEN": 0.27, "CZK": 0.046, "PLN": 0.26, "SEK": 0.096, "NOK": 0.094, "DKK": 0.145, "HUF": 0.0028, "RON": 0.22,
    "TRY": 0.031, "ZAR": 0.055, "INR": 0.012, "CNY": 0.14, "KRW": 0.00075, "SGD": 0.74, "MYR": 0.22, "THB": 0.029, "IDR": 0.000063, "PHP": 0.018,
    "EGP": 0.021, "NGN": 0.00065, "KES": 0.0078, "RUB": 0.011, "UAH": 0.027, "SAR": 0.27, "AED": 0.27, "ILS": 0.28, "NZD": 0.61, "TWD": 0.032,
    "HKD": 0.13, "PKR": 0.0036, "BDT": 0.0091, "LKR": 0.0034, "BGN": 0.55, "RSD": 0.0092, "HRK": 0.14, "ISK": 0.0073, "YER": 0.0040,
    "IRR": 0.0000238, "SYP": 0.0000769, "XOF": 0.00164, "IQD": 0.000763, "KZT": 0.00210, "NPR": 0.00750, "VND": 0.0000380, "MAD": 0.1000,
    "LYD": 0.2000, "GHS": 0.0670, "MNT": 0.000290, "KPW": 0.00111, "UGX": 0.000270, "XAF": 0.00164,
}

#: The catalogue's own, shorter tables.
CATALOGUE_RATES = {
    "USD": 1.0, "US$": 1.0, "$": 1.0, "EUR": 1.08, "€": 1.08, "GBP": 1.27, "£": 1.27, "CHF": 1.13, "CAD": 0.74, "AUD": 0.65,
    "JPY": 0.0067, "CNY": 0.14, "COP": 0.00024, "BRL": 0.20, "MXN": 0.058,
}

#: How the catalogue shows countries.
COUNTRY_DISPLAY = {
    "usa": "Estados Unidos", "us": "Estados Unidos", "eeuu": "Estados Unidos", "ee.uu.": "Estados Unidos", "united states": "Estados Unidos",
    "estados unidos": "Estados Unidos", "uk": "Reino Unido", "united kingdom": "Reino Unido", "gran bretana": "Reino Unido", "corea": "Corea del Sur",
    "south korea": "Corea del Sur", "netherlands": "Países Bajos", "holanda": "Países Bajos", "paises bajos": "Países Bajos", "switzerland": "Suiza",
    "germany": "Alemania", "spain": "España", "china": "China", "brazil": "Brasil", "mexico": "México", "colombia": "Colombia",
}

#: Publishers that a name is matched with.
PUBLISHERS = (
    "MDPI", "Elsevier", "Springer", "IEEE", "ACM", "Wiley", "Nature", "Taylor & Francis", "World Scientific", "INFORMS",
    "Emerald", "SciOpen", "Oxford", "Frontiers", "SAGE",
)

#: Topics and the words that tell them, in order; the topic of the others.
TOPIC_RULES = (
    ("Inteligencia Artificial", ("artificial intelligence", "intelligen", " ai ", "cognitive")),
    ("Aprendizaje Automático", ("machine learning", "machine intelligence", "neural", "deep learning", "learning")),
    ("Ciencias de la Computación", ("computer", "computing", "computational", "software")),
    ("Redes y Telecomunicaciones", ("network", "telecommunication", "communication", "wireless")),
    ("Internet de las Cosas (IoT)", ("internet of things", "iot", "cyber-physical")),
    ("Ciberseguridad y Privacidad", ("security", "privacy", "cyber", "forensic", "trust")),
    ("Big Data y Datos", ("big data", "data science", "data mining", "database", "data ")),
    ("Computación en la Nube", ("cloud", "edge computing", "distributed", "grid")),
    ("Sistemas Inteligentes y Control", ("control", "fuzzy", "systems", "automation")),
    ("Electrónica y Microprocesadores", ("electronic", "circuits", "vlsi", "microprocessor")),
    ("Agronomía y Agricultura", ("agricultur", "agronom", "crop", "farming", "precision ag")),
    ("Sostenibilidad y Medio Ambiente", ("sustainab", "environment", "energy", "green", "climate")),
    ("Multimedia y Sistemas Digitales", ("multimedia", "image", "video", "graphics", "vision")),
    ("Sistemas de Información", ("information", "management", "informatics")),
    ("Comercio Electrónico", ("commerce", "e-business", "electronic commerce")),
    ("Robótica y Automatización", ("robot", "automation", "mechatronic")),
    ("Blockchain y Criptografía", ("blockchain", "cryptograph", "ledger")),
    ("Matemáticas Computacionales", ("mathematic", "algorithm", "optimization")),
    ("Redes de Sensores", ("sensor",)),
    ("Redes Sociales", ("social",)),
)
DEFAULT_TOPIC = "Ingeniería General"

#: Names of languages.
LANGUAGE_NAMES = {
    "english": "Inglés", "spanish": "Español", "portuguese": "Portugués", "french": "Francés", "german": "Alemán", "italian": "Italiano",
    "catalan": "Catalán", "chinese": "Chino", "russian": "Ruso",
}

#: Words that hint at a field's language, looked for between spaces.
HINTS_ES = ("el", "la", "los", "las", "de", "del", "y", "para", "en", "ciencias", "revista", "español", "espanol", "salud", "derecho", "economía", "economia", "sociales", "publica")
HINTS_EN = ("the", "of", "and", "for", "in", "journal", "science", "studies", "research", "english", "health", "public", "innovation", "technology", "humanities", "social", "sciences", "life", "agronomy", "economics", "law")

#: What counts as free, as an amount with its currency or range, and as a duration in a catalogue text.
FREE = r"(?i)\b(gratis|gratuito|free|sin costo|no apc|sin apc|diamond|diamante)\b"
AMOUNT = r"(?i)(USD|US\$|EUR|GBP|CHF|CAD|AUD|JPY|CNY|COP|BRL|MXN|€|£|\$)?\s*([0-9][0-9.,]*)(?:\s*[-–—]\s*([0-9][0-9.,]*))?\s*(USD|EUR|GBP|CHF)?"
DURATION = r"(?i)([0-9]+(?:[.,][0-9]+)?)\s*(?:[-–—a]\s*([0-9]+(?:[.,][0-9]+)?))?\s*(mes(?:es)?|months?|semanas?|weeks?|dias?|days?)"

#: Mathematics and commands that prose is rid of, in this order, and the dashes after them.
FORMULAS = (
    r"(?is)\b(?:equation|align|gather|math)\*?\b.*?\bend\b",
    r"(?s)\$\$.*?\$\$|\\\(.*?\\\)|\\\[.*?\\\]",
    r"\$(?:[^$]|\\\$)+\$",
    r"\\[a-zA-Z]+\s*",
)
DASH_RUN = "--"

#: What a page layout leaves in text: hyphens that may break, joined letters, broken words, runs of blanks.
SOFT_HYPHEN = "\u00ad"
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
LAYOUT_BREAK = r"(?U)(?<=\w)-\s*\n\s*(?=\w)"
LAYOUT_BLANKS = {r"[ \t]+": " ", r"\n{3,}": "\n\n"}

#: Headings that end a list of keywords, and all that follows.
NEXT_SECTION = r"(?is)\b(introducci[oó]n|introduction|materiales\s+y\s+m[eé]todos|methods?|metodolog[ií]a|resumen|resumo|abstract)\b.*"
