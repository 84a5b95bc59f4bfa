"""Fixed values that results depend on, and the engine's typed configuration."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

# Query parameters that only track.
TRACKING_PARAMS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "spm", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
# Quota regions in their order, and what names them.
REGIONS = ("Global", "UAE", "KSA", "Egypt")
REGION_ALIASES = {"global": "Global", "uae": "UAE", "united arab emirates": "UAE", "emirates": "UAE", "ksa": "KSA", "saudi arabia": "KSA", "kingdom of saudi arabia": "KSA", "egypt": "Egypt", "arab republic of egypt": "Egypt"}
REGION_KEYWORDS = {
    "UAE": ("uae", "united arab emirates", "dubai", "abu dhabi", "emirati", "sharjah"),
    "KSA": ("ksa", "saudi arabia", "saudi", "riyadh", "jeddah", "neom", "jazan"),
    "Egypt": ("egypt", "egyptian", "cairo", "alexandria", "suez"),
}
# Other places that stories are told of; they count for the first region.
OTHER_LOCATIONS = {
    "Iraq": ("iraq", "iraqi", "baghdad", "basra"), "Qatar": ("qatar", "qatari", "doha"), "Libya": ("libya", "libyan", "tripoli"),
    "Bahrain": ("bahrain", "bahraini", "manama"), "Kuwait": ("kuwait", "kuwaiti"), "Oman": ("oman", "omani", "muscat"),
    "Jordan": ("jordan", "jordanian", "amman"), "Lebanon": ("lebanon", "lebanese", "beirut"), "Iran": ("iran", "iranian", "tehran"),
    "Yemen": ("yemen", "yemeni"), "Syria": ("syria", "syrian"), "Morocco": ("morocco", "moroccan"), "Algeria": ("algeria", "algerian"),
    "Tunisia": ("tunisia", "tunisian"), "Sudan": ("sudan", "sudanese"), "Israel": ("israel", "israeli"), "Palestine": ("palestine", "palestinian", "gaza"),
}
# Words that don't tell events apart.
EVENT_STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in", "into", "is", "it", "its", "new", "of", "on", "says", "the", "to", "with", "will", "energy", "transition", "investment", "investments", "expands")
# Forms of words that tell one event, and the words of policies and announcements.
EVENT_WORD_FORMS = {"grow": "production", "grows": "production", "growing": "production", "locally": "local", "updated": "update", "updates": "update", "revised": "update", "revises": "update", "revision": "update", "approved": "approve", "approves": "approve", "approval": "approve", "adopted": "adopt", "adopts": "adopt", "announced": "announce", "announces": "announce", "launched": "launch", "launches": "launch", "policies": "policy", "regulations": "regulation", "plans": "plan", "targets": "target"}
POLICY_WORDS = ("policy", "strategy", "regulation", "law", "plan")
ANNOUNCEMENT_WORDS = ("update", "approve", "adopt", "announce", "launch")
# Story types, those never in scope, and those in scope only if news.
STORY_TYPES = ("development", "policy_regulation", "investment_financing", "infrastructure_project", "research_result", "investigation", "supply_disruption", "explainer_background", "commentary_opinion", "politics_diplomacy", "conflict_security", "humanitarian_relief", "routine_event", "other")
EXCLUDED_STORIES = ("politics_diplomacy", "conflict_security", "humanitarian_relief", "routine_event")
BACKGROUND_STORIES = ("explainer_background", "commentary_opinion")
# What an attempt on a source can end with.
SUCCESS_OUTCOMES = ("Success", "Unchanged", "Empty")
FAILURE_OUTCOMES = ("Parse Error", "HTTP Error")
# Unit words and their short forms.
UNITS = {
    "percentage": "%", "percent": "%", "megawatt": "mw", "megawatts": "mw", "kilowatt": "kw", "kilowatts": "kw", "gigawatt": "gw", "gigawatts": "gw",
    "terawatt": "tw", "terawatts": "tw", "megawatt-hour": "mwh", "megawatt-hours": "mwh", "kilowatt-hour": "kwh", "kilowatt-hours": "kwh",
    "gigawatt-hour": "gwh", "gigawatt-hours": "gwh", "terawatt-hour": "twh", "terawatt-hours": "twh", "cubic meter": "m3", "cubic meters": "m3",
    "cubic metre": "m3", "cubic metres": "m3", "kilometer": "km", "kilometers": "km", "kilometre": "km", "kilometres": "km", "year": "year", "years": "year",
    "month": "month", "months": "month", "day": "day", "days": "day", "ton": "ton", "tons": "ton", "tonne": "tonne", "tonnes": "tonne",
}
# Whose nationality names a participant of an event, not its place, and what the participants are.
PARTICIPANT_ORIGINS = ("saudi", "uae", "emirati", "egyptian", "iraqi", "qatari", "bahraini", "kuwaiti", "omani")
PARTICIPANTS = ("company", "firm", "developer", "contractor", "utility")
# Places of interest, and places outside it.
INTEREST_PLACES = (
    "mena", "middle east", "gulf", "gcc", "uae", "united arab emirates", "dubai", "abu dhabi", "ksa", "saudi", "saudi arabia", "riyadh", "jeddah", "neom", "egypt", "egyptian", "cairo", "suez", "bahrain",
    "bahraini", "kuwait", "oman", "qatar", *(name for names in OTHER_LOCATIONS.values() for name in names),
)
OUTSIDE_PLACES = (
    "istanbul", "turkey", "turkish", "paris", "france", "berlin", "germany", "sydney", "boston", "mumbai", "alaska", "america", "american", "australia", "beijing", "britain", "canada", "central asia", "chennai",
    "china", "chinese", "cote d'ivoire", "delhi", "england", "europe", "european", "florida", "india", "indian", "indonesia", "ireland", "japan", "latin america", "melbourne", "mexico", "modi", "nepal", "pakistan",
    "thailand", "tribal", "trump", "uk ", "u.s.", "us epa", "usa", "united states", "venezuela", "washington",
)
# Other forms of a keyword, keywords that only match whole, and what is negated by a not, neither or nor before it.
KEYWORD_VARIANTS = {
    "grid": ("grids",), "crop": ("crops",), "farm": ("farms",), "battery": ("batteries",), "water utility": ("water utilities",), "food system": ("food systems",), "fertilizer": ("fertiliser", "fertilisers"),
    "energy efficiency": ("energy efficiencies",), "policy": ("policies",),
}
WHOLE_KEYWORDS = ("water", "carbon")
NEGATED = ("water", "energy", "carbon", "solar", "wind", "food security")
# The topics of a run, the words that stand for each directly, and those that do so only in context.
TOPIC_NAMES = ("food security", "water security", "net zero transition", "energy transition", "trade", "resilience", "regulation", "supply chains", "desalination", "agri-food")
DIRECT_KEYWORDS = {
    "food security": ("food security", "food system", "agri-food", "agrifood", "agriculture", "agricultur", "farming", "farm", "crop", "grain", "fertilizer", "livestock", "aquaculture", "veal", "harvest"),
    "water security": (
        "water security", "water treatment", "water reuse", "water utility", "drinking water", "groundwater", "wastewater", "waste water", "desalination", "desal", "irrigation", "aquifer", "water", "nile dam",
        "nile basin", "dam dispute", "river basin",
    ),
    "net zero transition": (
        "net zero", "decarbon", "emission", "carbon", "climate target", "climate policy", "energy efficiency", "electrification", "renewable", "solar", "wind", "battery", "energy storage", "battery storage", "grid",
        "hydrogen", "clean energy", "low-carbon",
    ),
    "energy transition": ("energy transition", "renewable", "solar", "wind", "battery", "energy storage", "battery storage", "grid", "hydrogen", "clean energy", "low-carbon"),
    "resilience": ("drought", "flood", "flooding", "water stress"),
    "desalination": ("desalination", "desal", "reverse osmosis", "brine"),
    "agri-food": ("agri-food", "agrifood", "food system", "agriculture", "agricultur", "crop", "grain", "fertilizer", "farm", "farming", "livestock", "veal", "harvest"),
}
CONTEXT_KEYWORDS = {
    "net zero transition": ("climate", "electricity", "power sector"),
    "energy transition": ("electricity", "power sector", "lng", "oil", "gas", "petrochem"),
    "trade": ("trade", "trading", "export", "import", "tariff", "shipping", "logistics", "port", "commodity", "corridor"),
    "resilience": ("resilience", "adaptation", "heatwave", "disruption"),
    "regulation": ("regulation", "regulatory", "policy", "legislation", "law", "compliance", "standard", "framework"),
    "supply chains": ("supply chain", "supply chains", "shipping", "logistics", "freight", "port", "corridor"),
}
# The patterns of systemic scope (each row all at once), of local focus, of the strength of a mission, and of what lies beside it.
SYSTEMIC_PATTERNS = (
    (r"\b(?:global|world(?:wide)?) (?:food|fertili[sz]er|grain|water|energy|solar|battery|carbon) (?:supply|security|markets?|prices?|shortages?|trade)\b",),
    (r"\b(?:hormuz|suez canal)\b", r"\b(?:fertili[sz]er|food security|food crisis|grain supplies|harvests?)\b", r"\b(?:supply|supplies|shipping|disruption|crisis|trade)\b"),
    (r"\b(?:world bank|islamic development bank|fao|united nations)\b", r"\b(?:food security|water security|renewable energy|decarbon\w*)\b", r"\b(?:mobilis\w*|mobiliz\w*|funding|financing|invest\w*|supply)\b"),
)
OVERSEAS_PATTERNS = (r"\bacross (?:the )?(?:us|u\.s\.|europe)\b", r"\b(?:invest\w*|agreements?)\b", r"\b(?:power grids?|renewable energy|battery storage)\b")
LOCAL_FOCUS = r"\b(?:schools?|municipal|city council|local residents|urban water|local infrastructure)\b"
SPECIFIC_MISSION = r"\b(?:food security|fertili[sz]ers?|desalination|wastewater|water reuse|water treatment|irrigation|battery|batteries|power grids?|decarbon\w*)\b"
CONCRETE_DEVELOPMENT = r"\b(?:projects?|plants?|facilit\w*|invest\w*|technolog\w*|capacity|agreements?|contracts?|approv\w*|commissioned|commissioning|commissions|legislation|mandates?|policy changes?|regulations?)\b"
BATTERY, BATTERY_USE = r"\bbatter(?:y|ies)\b", (
    r"\b(?:energy transition|net[- ]zero|decarbon\w*|energy storage|grid|grids|renewable\w*|solar|wind|electric vehicles?|evs?|charging|recycl\w*|commercial\w*|manufactur\w*|factor\w*|assembly|deploy\w*|pilot|"
    r"utility[- ]scale|battery suppl\w*|batter(?:y|ies) (?:projects?|plants?|facilit\w*)|mwh|gwh|megawatt\w*|gigawatt\w*)\b"
)
BATTERY_TOPICS, BATTERY_RESCUES = ("energy transition", "net zero transition"), ("food security", "water security", "desalination", "agri-food")
OFF_MISSION = (r"\b(?:crypto\w*|bitcoin|digital assets?)\b", r"\b(?:flights?|passengers?|travellers?|travelers?)\b")
# Own configuration data: topics and the words that stand for them directly, or only in context.
TOPICS = {
    "Water": (("irrigation", "desalination", "groundwater", "drinking water", "wastewater"), ("river", "rain", "reservoir")),
    "Food": (("harvest", "crop yield", "fertiliser", "food security"), ("farm", "grain", "market")),
    "Energy": (("solar", "wind farm", "battery storage", "power grid"), ("plant", "fuel", "emission")),
}


@dataclass(frozen=True)
class EngineConfig:
    """All parameters of a run, checked together."""

    targets: tuple[int, ...] = (3, 4, 3, 2)
    run_limit: int = 12
    minimum_relevance: int = 4
    unregistered_relevance: int = 5
    fallback_floor: int = 3
    publisher_cap: int = 2
    freshness_days: int = 7
    shortlist_initial: int = 6
    shortlist_max: int = 8
    budget_initial: int = 32
    budget_max: int = 48
    backfill: int = 8
    weights: tuple[float, float, float] = (0.70, 0.20, 0.10)
    event_similarity: float = 0.72
    snippet_cap: int = 600
    evidence_min: int = 300
    evidence_max: int = 12_000
    self_domain: str = "self.example.org"
    topics: dict = field(default_factory=lambda: TOPICS)

    def validate(self) -> EngineConfig:
        """Raises one error that lists everything wrong."""
        wrong = []
        if len(self.targets) != len(REGIONS) or min(self.targets) < 0:
            wrong.append("targets: one number of 0 or more for each region")
        for name in ("run_limit", "publisher_cap", "freshness_days", "shortlist_initial", "budget_initial", "backfill"):
            if getattr(self, name) < 1:
                wrong.append(f"{name}: at least 1")
        if self.shortlist_max < self.shortlist_initial or self.budget_max < self.budget_initial:
            wrong.append("a maximum is no less than its initial value")
        if not 1 <= self.minimum_relevance <= 5 or not 1 <= self.unregistered_relevance <= 5:
            wrong.append("relevance is from 1 to 5")
        if len(self.weights) != 3 or abs(sum(self.weights) - 1) > 1e-9:
            wrong.append("weights: three, which add up to 1")
        if wrong:
            raise ValueError("; ".join(wrong))
        return self


def load_config(env: dict[str, str] | None = None, prefix: str = "MILLRACE_") -> EngineConfig:
    """Configuration from the environment: whole numbers are read strictly, what is unset keeps its default.

    Targets and weights are numbers with commas between, topics a JSON object from a topic to its direct and contextual words.
    """
    env, given, wrong = os.environ if env is None else env, {}, []
    for f in fields(EngineConfig):
        raw = env.get(prefix + f.name.upper(), "").strip()
        if not raw:
            continue
        if f.name == "topics":
            try:
                given[f.name] = {t: (tuple(direct), tuple(context)) for t, (direct, context) in json.loads(raw).items()}
            except (ValueError, TypeError, AttributeError):
                wrong.append("topics: not an object of two lists each")
            continue
        if f.name in ("targets", "weights"):
            try:
                given[f.name] = tuple((int if f.name == "targets" else float)(x.strip()) for x in raw.split(","))
            except ValueError:
                wrong.append(f"{f.name}: not numbers")
            continue
        if f.type == "str":
            given[f.name] = raw
            continue
        try:
            given[f.name] = int(raw) if f.type == "int" else float(raw)
        except ValueError:
            wrong.append(f"{f.name}: not a number")
    if wrong:
        raise ValueError("; ".join(wrong))
    return EngineConfig(**given).validate()
