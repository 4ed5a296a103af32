"""Sector and country vocabularies."""

from __future__ import annotations

# The scoring vocabulary of sectors.
SECTORS = (
    "communications", "data storage and processing", "defence industry", "energy", "financial services",
    "food and grocery", "health care", "higher education and research", "space technology", "transport",
    "water and sewerage", "government", "manufacturing", "technology", "media", "retail", "legal", "military", "ngo",
)

# Surface forms of sectors.
SECTOR_SYNONYMS = {
    "telecom": "communications", "telecoms": "communications", "telecommunications": "communications", "telco": "communications", "isp": "communications",
    "cloud": "data storage and processing", "cloud services": "data storage and processing", "data centre": "data storage and processing", "data center": "data storage and processing",
    "defense industry": "defence industry", "defence": "defence industry", "defense": "defence industry", "defence industrial base": "defence industry", "defense industrial base": "defence industry",
    "oil and gas": "energy", "oil & gas": "energy", "power": "energy", "electricity": "energy", "electric power": "energy", "nuclear": "energy", "utilities": "energy",
    "finance": "financial services", "financial": "financial services", "financial services and markets": "financial services", "banking": "financial services", "banks": "financial services", "insurance": "financial services", "fintech": "financial services", "cryptocurrency": "financial services",
    "food": "food and grocery", "agriculture": "food and grocery",
    "healthcare": "health care", "health": "health care", "health care and medical": "health care", "hospitals": "health care", "medical": "health care", "pharmaceutical": "health care", "pharmaceuticals": "health care",
    "education": "higher education and research", "universities": "higher education and research", "university": "higher education and research", "academia": "higher education and research", "research": "higher education and research",
    "space": "space technology", "aerospace": "space technology", "satellite": "space technology",
    "aviation": "transport", "airlines": "transport", "airline": "transport", "maritime": "transport", "shipping": "transport", "logistics": "transport", "rail": "transport", "railway": "transport",
    "water": "water and sewerage", "wastewater": "water and sewerage", "water utilities": "water and sewerage", "water treatment": "water and sewerage",
    "public sector": "government", "public administration": "government", "federal government": "government", "local government": "government", "diplomatic": "government",
    "industrial": "manufacturing",
    "it": "technology", "software": "technology", "information technology": "technology", "tech": "technology", "telecommunications and technology": "technology",
    "news media": "media", "journalism": "media", "press": "media",
    "law firms": "legal", "law": "legal",
    "defense contractors": "defence industry",
    "armed forces": "military",
    "civil society": "ngo", "non-profit": "ngo", "nonprofit": "ngo", "ngos": "ngo",
}

# Nouns that may trail a sector, in the order in which they are tried.
TRAILING_NOUNS = ("sector", "sectors", "industry", "industries", "organisations", "organizations", "organisation", "organization", "companies", "entities", "providers", "operators")

# Country names and demonyms.
COUNTRY_NAMES = {
    "united states": "US", "america": "US", "american": "US", "united kingdom": "GB", "britain": "GB", "british": "GB", "england": "GB",
    "australia": "AU", "australian": "AU", "new zealand": "NZ", "canada": "CA", "canadian": "CA", "ukraine": "UA", "ukrainian": "UA",
    "russia": "RU", "russian": "RU", "china": "CN", "chinese": "CN", "taiwan": "TW", "taiwanese": "TW", "hong kong": "HK",
    "japan": "JP", "japanese": "JP", "south korea": "KR", "north korea": "KP", "india": "IN", "indian": "IN", "pakistan": "PK",
    "iran": "IR", "iranian": "IR", "israel": "IL", "israeli": "IL", "saudi arabia": "SA", "united arab emirates": "AE", "qatar": "QA",
    "kuwait": "KW", "jordan": "JO", "lebanon": "LB", "iraq": "IQ", "syria": "SY", "turkey": "TR", "turkish": "TR", "egypt": "EG",
    "germany": "DE", "german": "DE", "france": "FR", "french": "FR", "italy": "IT", "italian": "IT", "spain": "ES", "spanish": "ES",
    "netherlands": "NL", "dutch": "NL", "belgium": "BE", "poland": "PL", "polish": "PL", "sweden": "SE", "norway": "NO", "finland": "FI",
    "denmark": "DK", "switzerland": "CH", "austria": "AT", "ireland": "IE", "portugal": "PT", "czech republic": "CZ", "czechia": "CZ",
    "slovakia": "SK", "hungary": "HU", "romania": "RO", "bulgaria": "BG", "greece": "GR", "serbia": "RS", "croatia": "HR", "slovenia": "SI",
    "estonia": "EE", "latvia": "LV", "lithuania": "LT", "belarus": "BY", "moldova": "MD", "georgia": "GE", "armenia": "AM", "azerbaijan": "AZ",
    "kazakhstan": "KZ", "uzbekistan": "UZ", "mongolia": "MN", "singapore": "SG", "malaysia": "MY", "thailand": "TH", "vietnam": "VN",
    "vietnamese": "VN", "philippines": "PH", "indonesia": "ID", "myanmar": "MM", "cambodia": "KH", "laos": "LA", "bangladesh": "BD",
    "sri lanka": "LK", "nepal": "NP", "afghanistan": "AF", "brazil": "BR", "brazilian": "BR", "mexico": "MX", "argentina": "AR",
    "chile": "CL", "colombia": "CO", "south africa": "ZA", "nigeria": "NG", "kenya": "KE",
}

# Abbreviations that count only as written here.
COUNTRY_ABBREVIATIONS = {"US": "US", "U.S.": "US", "USA": "US", "U.S.A.": "US", "UK": "GB", "U.K.": "GB", "UAE": "AE", "PRC": "CN", "ROK": "KR", "DPRK": "KP", "NZ": "NZ"}

# Words that mark reporting on actors and campaigns.
THREAT_WORDS = ("threat actor", "apt", "campaign", "attribut", "state-sponsored", "ransomware", "intrusion", "adversary", "espionage", "tradecraft")

# Ranks, weakest first.
CONFIDENCE = ("low", "medium", "high")
ATTRIBUTION = ("suspected", "likely", "confirmed_by_source")
IOC_KINDS = ("ipv4", "ipv6", "domain", "url", "sha256", "md5", "email")
EVENT_KINDS = ("sanctions", "summit", "military", "election", "treaty", "other")
FEED_KINDS = ("rss", "atom", "html", "json")
RUN_STATUS = ("ok", "invalid_json", "schema_fail", "api_error")
