"""Fixed values that results depend on: patterns, codes, names and maps, in the order in which they are tried."""

# fixed values: issue dates; the ninth has no group (see extract.dates)
ISSUE_DATE = [
    r"(?:issue\s+date|date\s+of\s+issue|issuance\s+date)\s*[:\-]?\s*(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"(?:issue\s+date|date\s+of\s+issue|issuance\s+date)\s*[:\-]?\s*(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:issue\s+date|date\s+of\s+issue|issuance\s+date)\s*[:\-]?\s*(?:on\s+)?(\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:date\s+of\s+)?(?:initial\s+)?issu(?:e|ance)\s*(?:of\s+the\s+notes)?\s*(?:is|will\s+be)\s*(?:on\s+)?(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:date\s+of\s+)?(?:initial\s+)?issu(?:e|ance)\s*(?:of\s+the\s+notes)?\s*(?:is|will\s+be)\s*(?:on\s+)?(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"(?:supplement|prospectus)\s+dated\s+(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:supplement|prospectus)\s+dated\s+(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"issue\s+of\s+(?:[A-Z]{3}|\$|€|£|¥)[\d,.]+(?:million|billion|m|bn)?\s+[\d.]+\s*%.*?dated\s+(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"(?:issue\s+date|date\s+of\s+issue|issuance\s+date)\s*[:\-]?\s*(?:(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2}(?:st|nd|rd|th)?,?\s+\d{2,4})",
    r"(?:FC\d+)_(\d{8})_",
]
NO_GROUP = 8

# fixed values: maturity dates
MATURITY_DATE = [
    r"(?:maturity\s+date|final\s+maturity|redemption\s+date)\s*[:\-]?\s*(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"(?:maturity\s+date|final\s+maturity|redemption\s+date)\s*[:\-]?\s*(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:maturity\s+date|final\s+maturity|redemption\s+date)\s*[:\-]?\s*(?:on\s+)?(\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:will\s+mature|matures|to\s+mature)\s*(?:on|at)\s*(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"(?:will\s+mature|matures|to\s+mature)\s*(?:on|at)\s*(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"due\s+(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"due\s+(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"due\s+(?:in\s+)?(\d{4})",
    r"notes?\s+maturing\s+(?:in|on)\s+(\d{1,2}(?:st|nd|rd|th)?\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{2,4})",
    r"notes?\s+maturing\s+(?:in|on)\s+(\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4})",
    r"notes?\s+maturing\s+(?:in\s+)?(\d{4})",
]

# fixed values: bank roles
BANK_ROLES = [
    r"(?:joint\s+)?(?:lead\s+)?(?:book[\-\s]?runner|manager|arranger|dealer|coordinator)",
    r"(?:joint\s+)?(?:lead\s+)?(?:book[\-\s]?runner|manager|arranger|dealer|coordinator)s?",
    r"co[\-\s]?(?:lead\s+)?(?:book[\-\s]?runner|manager|arranger|dealer)",
    r"co[\-\s]?(?:lead\s+)?(?:book[\-\s]?runner|manager|arranger|dealer)s?",
    r"(?:global|principal|structuring)\s+coordinator",
    r"(?:global|principal|structuring)\s+coordinators?",
    r"structuring\s+(?:advisor|agent|bank)",
    r"structuring\s+(?:advisors?|agents?|banks?)",
    r"(?:billing\s+and\s+)?delivery\s+(?:bank|agent)",
    r"(?:billing\s+and\s+)?delivery\s+(?:banks?|agents?)",
    r"stabili[sz](?:ation|ing)\s+(?:manager|agent|bank)",
    r"stabili[sz](?:ation|ing)\s+(?:managers?|agents?|banks?)",
    r"calculation\s+(?:agent|bank)",
    r"calculation\s+(?:agents?|banks?)",
    r"(?:principal|fiscal|paying|issuing|transfer|registration)\s+(?:agent|bank)",
    r"(?:principal|fiscal|paying|issuing|transfer|registration)\s+(?:agents?|banks?)",
    r"(?:trustee|listing\s+agent|registrar)",
    r"(?:trustees?|listing\s+agents?|registrars?)",
    r"dealer\s+manager",
    r"dealer\s+managers?",
    r"placement\s+agent",
    r"placement\s+agents?",
    r"underwriter",
    r"underwriters?",
    r"initial\s+purchaser",
    r"initial\s+purchasers?",
]

# fixed values: known banks
BANKS = [
    r"J\.?P\.?\s*Morgan", r"JPMorgan", r"J\.?P\.?\s*Morgan\s+Chase",
    r"Goldman\s+Sachs", r"Morgan\s+Stanley", r"HSBC",
    r"Barclays", r"Deutsche\s+Bank", r"BNP\s+Paribas",
    r"Credit\s+Agricole", r"Credit\s+Agricole\s+CIB",
    r"Citi(?:group)?", r"Bank\s+of\s+America", r"BofA\s+Securities",
    r"Merrill\s+Lynch", r"UBS", r"RBC", r"Royal\s+Bank\s+of\s+Canada",
    r"Soci[eé]t[eé]\s+G[eé]n[eé]rale", r"SG", r"SocGen",
    r"Wells\s+Fargo", r"Credit\s+Suisse", r"Nomura",
    r"Mizuho", r"Santander", r"BBVA", r"UniCredit",
    r"Standard\s+Chartered", r"Scotiabank", r"ING",
    r"DNB", r"Natixis", r"SMBC", r"Sumitomo\s+Mitsui",
    r"NatWest", r"RBS", r"Royal\s+Bank\s+of\s+Scotland",
    r"Banco\s+Bilbao", r"Commerzbank", r"Danske\s+Bank",
    r"LBBW", r"Nord/LB", r"BayernLB", r"DZ\s+Bank",
    r"CIBC", r"ABN\s+AMRO", r"Rabobank", r"Intesa\s+Sanpaolo",
    r"Natwest\s+Markets", r"Lloyds", r"BNY\s+Mellon",
    r"Nordea", r"BMO", r"Bank\s+of\s+Montreal", r"TD\s+Securities",
    r"Handelsbanken", r"SEB", r"Swedbank", r"Citibank",
    r"PNC", r"US\s+Bancorp", r"Jefferies", r"Mitsubishi\s+UFJ",
    r"MUFG", r"Bank\s+of\s+China", r"Commonwealth\s+Bank",
    r"China\s+Construction\s+Bank", r"ICBC", r"ANZ",
    r"Westpac", r"NAB", r"National\s+Australia\s+Bank",
    r"Standard\s+Bank", r"First\s+Abu\s+Dhabi\s+Bank", r"FAB",
    r"Emirates\s+NBD", r"Qatar\s+National\s+Bank", r"QNB",
    r"Samba", r"KfW", r"La\s+Caixa", r"CaixaBank",
    r"Landesbank", r"Helaba", r"WestLB", r"Belfius",
    r"Fortis", r"Mediobanca", r"BayernLB",
]

# fixed values: currencies
CURRENCY_CODES = [
    "USD", "EUR", "GBP", "JPY", "CHF", "AUD", "CAD",
    "NZD", "HKD", "SGD", "CNY", "CNH", "SEK", "NOK",
    "DKK", "CZK", "HUF", "PLN", "RUB", "TRY", "ZAR",
    "MXN", "BRL", "AED", "SAR", "QAR", "KWD", "INR",
]
CURRENCY_SYMBOLS = [r"\$", r"€", r"£", r"¥", r"Fr", r"kr", r"₽", r"₺", r"R\s", r"₹"]
SYMBOL_TO_CODE = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "Fr": "CHF", "kr": "NOK", "₽": "RUB", "₺": "TRY", "R": "ZAR", "₹": "INR"}
#: What white space is deleted beside; a multi-letter symbol counts by its letters.
TIGHT = "$€£¥Frk₽₺R₹"

# fixed values: issue size
ISSUE_SIZE = [
    r"(?:aggregate\s+(?:nominal\s+)?amount|(?:total\s+)?(?:issue|principal)\s+(?:size|amount)|series\s+amount)\s*(?:of\s+(?:the\s+)?(?:notes|securities|bonds))?\s*[:\-]?\s*(?:up\s+to\s+)?([A-Z]{3}|\$|€|£|¥|Fr|₽|₺|R\s|kr|₹)?\s*[\d,.]+\s*(?:million|billion|m|bn)?(?:\s*([A-Z]{3}))?",
    r"(?:aggregate\s+(?:nominal\s+)?amount|(?:total\s+)?(?:issue|principal)\s+(?:size|amount)|series\s+amount)\s*(?:of\s+(?:the\s+)?(?:notes|securities|bonds))?\s*[:\-]?\s*(?:up\s+to\s+)?((?:USD|EUR|GBP|JPY|CHF|AUD|CAD|NZD|HKD|SGD|CNY|CNH|SEK|NOK|DKK|CZK|HUF|PLN|RUB|TRY|ZAR|MXN|BRL|AED|SAR|QAR|KWD|INR))\s*[\d,.]+\s*(?:million|billion|m|bn)?",
    r"[A-Z]{3}[-\s]denominated\s+(?:senior\s+)?(?:unsecured\s+)?notes?\s+(?:due\s+\d{4}\s+)?(?:in\s+(?:the\s+)?(?:aggregate\s+)?(?:principal\s+)?(?:amount\s+)?(?:of\s+)?)?\s*([A-Z]{3}|\$|€|£|¥|Fr|₽|₺|R\s|kr|₹)?\s*[\d,.]+\s*(?:million|billion|m|bn)?",
    r"[\d,.]+\s*(?:million|billion|m|bn)?\s*([A-Z]{3}|\$|€|£|¥|Fr|₽|₺|R\s|kr|₹)\s+(?:aggregate\s+(?:principal\s+)?amount|(?:issue|principal)\s+(?:size|amount))",
    r"[\d,.]+\s*(?:million|billion|m|bn)?\s*((?:USD|EUR|GBP|JPY|CHF|AUD|CAD|NZD|HKD|SGD|CNY|CNH|SEK|NOK|DKK|CZK|HUF|PLN|RUB|TRY|ZAR|MXN|BRL|AED|SAR|QAR|KWD|INR))\s+(?:aggregate\s+(?:principal\s+)?amount|(?:issue|principal)\s+(?:size|amount))",
]
AMOUNT_PHRASES = [
    r"(?:aggregate\s+nominal\s+amount|issue\s+size|amount\s+of\s+the\s+notes|total\s+issue\s+size)\s*[:]\s*([A-Z]{3}|\$|€|£|¥)?\s*([\d,\.]+)\s*(?:million|billion|m|bn)?",
    r"(?:issue\s+of|issuance\s+of)\s*([A-Z]{3}|\$|€|£|¥)?\s*([\d,\.]+)\s*(?:million|billion|m|bn)?",
    r"(?:principal\s+amount)\s*[:]\s*([A-Z]{3}|\$|€|£|¥)?\s*([\d,\.]+)\s*(?:million|billion|m|bn)?",
    r"nominal\s+amount\s*[:]\s*(?:\([^\)]+\)\s*)?([A-Z]{3}|\$|€|£|¥)?\s*([\d,\.]+)\s*(?:million|billion|m|bn)?",
    r"([A-Z]{3}|\$|€|£|¥)\s*([\d,\.]+)\s*(?:million|billion|m|bn)?\s*(?:\d{1,2}[\.]\d{1,3})?\s*%\s*(?:notes|bonds)",
]
PROGRAMME = r"([\d,\.]+)\s*(?:billion|bn|million|m)?\s+Euro\s+Medium\s+Term\s+Note\s+Programme"

# fixed values: coupon
COUPON_RATE = [
    r"(?:interest\s+rate|coupon\s+rate|rate\s+of\s+interest|fixed\s+rate|coupon|interest)\s*[:\-]?\s*(?:of\s+)?(\d+(?:\.\d+)?)\s*(?:per\s*(?:cent\.?|%)|%)",
    r"(\d+(?:\.\d+)?)\s*(?:per\s*(?:cent\.?|%)|%)(?:\s+(?:fixed\s+)?(?:rate\s+)?(?:interest|coupon))",
    r"(?:bear\s+interest\s+at|pays|with|carries|offering|bearing)(?:\s+a)?\s*(?:fixed\s+)?(?:rate\s+)?(?:coupon\s+)?(?:of\s+)?(\d+(?:\.\d+)?)\s*(?:per\s*(?:cent\.?|%)|%)",
    r"fixed\s+(?:rate\s+)?notes?\s+(?:due\s+\d{4}\s+)?(?:with|paying|at|of|bearing)\s+(?:a\s+(?:coupon|interest)\s+(?:rate\s+)?(?:of\s+)?)?(\d+(?:\.\d+)?)\s*(?:per\s*(?:cent\.?|%)|%)",
]
COUPON_TYPES = [
    r"fixed\s+rate", r"floating\s+rate", r"zero\s+coupon",
    r"step[- ]up", r"step[- ]down", r"fixed[- ]to[- ]floating",
    r"floating[- ]to[- ]fixed", r"inflation[- ]linked", r"index[- ]linked",
    r"variable\s+rate", r"structured", r"range\s+accrual",
    r"fixed\s+spread", r"discount", r"premium",
]

# fixed values: sections
DISTRIBUTION = [r"\b(?:plan\s+of\s+)?distribution\b", r"\bsubscription\s+and\s+sale\b", r"\bplacement\s+of\s+the\s+notes\b"]
MANAGEMENT = [r"\bmanagers?\b", r"\bjoint\s+lead\s+managers?\b", r"\bbook(?:\-)?runners?\b"]

# fixed values: bank names
BANK_SUFFIX = r"\s+(?:AG|plc|ltd|limited|inc|incorporated|llc|gmbh|sa|corp|corporation|group|s\.?[ap]\.?|n\.?v\.?|[&,]?\s+co(?:mpany)?)\.?$"
BANK_PREFIX = r"^(?:the|by)\s+"
BANK_NAMES = {
    "j.p. morgan": "JPMorgan",
    "j. p. morgan": "JPMorgan",
    "jp morgan": "JPMorgan",
    "jpmorgan chase": "JPMorgan",
    "bank of america merrill lynch": "Bank of America",
    "bofa": "Bank of America",
    "bofa securities": "Bank of America",
    "barclays capital": "Barclays",
    "bnp": "BNP Paribas",
    "socgen": "Societe Generale",
    "société générale": "Societe Generale",
    "deutsche": "Deutsche Bank",
    "ubs ag": "UBS",
    "rbc capital": "RBC",
    "rbc capital markets": "RBC",
    "royal bank of canada": "RBC",
}
NOT_BANKS = [
    "issuer", "notes", "bonds", "securities", "issue date", "maturity date",
    "interest rate", "coupon", "form", "date", "page", "terms", "conditions",
    "final terms", "base prospectus", "offering", "offer", "document", "series",
    "rating", "summary", "financial", "amount", "size", "currency",
]
BANK_ENDING = r"(?:bank|capital|securities|asset|credit|invest|partners|financial|markets)$"
BANK_OF = r"^[A-Z][a-z]+(?:\s+(?:of|and|&)\s+[A-Z][a-z]+)+$"
PROPER_NAME = r"^[A-Z][a-zA-Z\s&']+$"
CONTEXT_STOP = r"\b(?:Notes|Securities|Bonds|Issuer|Issue|Maturity|Coupon|Rate|if|and|or|the|dated|will)\b"
CAPITALISED = r"\b[A-Z][a-zA-Z\s&']+(?:\([^)]+\))?\b"
CANDIDATE_STOP = r"\b(?:Page|Terms|Size|Amount|Total|Date|Final|Interest|Reference|Rate)\b"

# fixed values: file names, companies, diagnostics
FINAL_TERMS = ["final", "terms", "pricing", "supplement"]
RECOGNISED = ["prospectus", "final", "terms", "offering", "pricing"]
COMPANY_SUFFIXES = [" SE", " ASA", " SA", " NV", " AG", " plc", " Ltd", " LLC", " GmbH"]
EU_COUNTRIES = [
    "Austria", "Belgium", "Bulgaria", "Croatia", "Cyprus", "Czech Republic",
    "Denmark", "Estonia", "Finland", "France", "Germany", "Greece", "Hungary",
    "Ireland", "Italy", "Latvia", "Lithuania", "Luxembourg", "Malta",
    "Netherlands", "Poland", "Portugal", "Romania", "Slovakia", "Slovenia",
    "Spain", "Sweden",
]
DATE_KEYWORDS = [
    "issue date", "dated", "maturity date", "redemption date",
    "final maturity", "issuance date", "date of issue", "settlement date",
    "trade date", "effective date", "termination date", "value date",
    "issue", "issued on", "will be issued on", "to be issued on",
]
DATE_STRINGS = [
    r"\d{1,2}[-/]\d{1,2}[-/]\d{2,4}",
    r"\d{4}[-/]\d{2}[-/]\d{2}",
    r"\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}",
    r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}",
]
CONCORDANCE_NAMES = [
    "BNP Paribas", "Deutsche Bank", "Credit Suisse", "Morgan Stanley",
    "Goldman Sachs", "JP Morgan", "HSBC", "Barclays", "UBS", "Citigroup",
    "Bank of America", "BofA Securities", "Quadra Energy",
]
ERROR_COMPONENTS = ["scraper", "extractor", "name_matching"]
DEFAULT_FILE = "esma_doc_"


def counting_phrase(p: str) -> str:
    """An amount's phrase so that it matches only with a currency or symbol before the number (groups 1, 2), or with a number of more
    than commas (groups 3, 4)."""
    head, tail = p.split(r"([A-Z]{3}|\$|€|£|¥)", 1)
    maybe = tail.startswith("?")
    rest = tail.split(r"([\d,\.]+)", 1)[1]
    letters = "|".join(f"{a}{s}{b}" for s in SYMBOL_TO_CODE if s.isalpha() for k in [3 - len(s)] for i in range(k + 1) for a, b in [("[A-Za-z]" * i, "[A-Za-z]" * (k - i))])
    known = "|".join([*CURRENCY_CODES, r"\$", "€", "£", "¥", f"(?-i:{letters})"])
    return rf"{head}(?:({known})\s*([\d,\.]+)|([A-Z]{{3}}|\$|€|£|¥){'?' if maybe else ''}\s*([\d,\.]*[\d\.][\d,\.]*)){rest}"
