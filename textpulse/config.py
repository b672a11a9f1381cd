"""Settings of a run: thresholds, term lists and word lists.

Every list and threshold an operator uses is a field of :class:`Settings`, so a
caller can replace any of them with ``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType
from typing import Mapping

# --- Fixed values -----------------------------------------------------------
# The term lists below decide which messages match, so they must keep exactly
# these spellings and this order (the order of categories is the order of the
# names in ``search_category``).

SEARCH_TERMS: Mapping[str, tuple[str, ...]] = MappingProxyType({
    "recruitment": (
        "rural residency", "rural track", "rural training track", "RTT program",
        "ranked rural", "matched rural", "underserved area", "underserved community",
        "NHSC scholarship", "NHSC loan repayment", "loan forgiveness rural", "PSLF rural",
        "state loan repayment", "sign on bonus rural", "J1 waiver rural",
        "visa waiver underserved", "IMG rural",
    ),
    "partner_family": (
        "spouse won't move", "partner hates rural", "wife career rural", "husband job rural",
        "trailing spouse", "dual physician couple rural", "two body problem rural",
        "long distance residency", "relationship strain residency", "divorced during residency",
        "marriage residency", "kids in rural", "schools rural area", "childcare rural",
        "isolated with kids", "no family nearby", "significant other moved",
    ),
    "retention": (
        "quit rural", "left rural practice", "leaving rural", "moved back to city",
        "couldn't stay rural", "only stayed 2 years", "contract buyout", "burned out rural",
        "rural burnout", "isolated and burned out", "regret going rural", "regret rural",
        "wish I stayed urban", "should have stayed", "never go rural", "don't go rural",
        "rural was a mistake", "left after loan repayment", "finished NHSC and left",
        "3 year commitment rural",
    ),
    "isolation": (
        "middle of nowhere", "hours from anything", "nothing to do rural", "no restaurants",
        "no culture", "boring town", "small town everyone knows", "gossip small town",
        "no privacy rural", "dating rural", "single in rural", "no dating pool",
        "where to meet people rural", "friends rural area", "lonely rural",
        "isolated physician", "only doctor in town",
    ),
    "clinical_isolation": (
        "no backup rural", "only physician", "no specialist", "transfer patient hours",
        "medevac", "critical access hospital", "CAH hospital", "25 bed hospital",
        "scope creep rural", "NP independence rural", "mid-level supervision rural",
        "solo practice rural", "call every night", "1 in 2 call", "1 in 3 call",
        "always on call", "never off rural",
    ),
    "compensation": (
        "rural salary not worth", "paid more but miserable", "money isn't everything rural",
        "golden handcuffs rural", "contract trap rural", "non-compete rural",
        "can't leave contract", "buyout clause", "loan repayment trap", "stuck for 3 years",
        "RVU rural", "productivity rural", "admin burden rural", "panel size rural",
    ),
    "oregon_ohsu": (
        "OHSU rural", "Oregon rural residency", "Cascades East", "Oregon rural track",
        "Eastern Oregon", "Klamath Falls residency", "Bend Oregon medicine",
        "Portland vs rural Oregon", "Pacific Northwest rural", "Washington rural",
        "Idaho rural", "Montana rural",
    ),
    "career": (
        "rural career dead end", "no advancement rural", "can't do fellowship rural",
        "stuck in rural", "pigeonholed rural", "rural on CV", "coming back from rural",
        "re-entering urban", "transition rural to urban", "escape rural",
    ),
})

RELEVANCE_TERMS = (
    "residency", "resident", "attending", "physician", "doctor", "md", "do", "rotation",
    "match", "program", "fellowship", "intern", "pgy", "medical school", "med school",
    "clinical", "hospital", "clinic", "patient", "surgery", "medicine", "fm",
    "family medicine", "im", "internal medicine", "pediatrics", "obgyn", "psychiatry",
    "emergency", "radiology", "pathology", "anesthesia", "icu", "wards", "step 1", "step 2",
    "usmle", "comlex", "eras", "nrmp", "soap",
)

REGION_TERMS = (
    "oregon", "ohsu", "portland", "pacific northwest", "pnw", "bend", "eugene", "salem",
    "corvallis", "medford",
)

PARTNER_TERMS = (
    "wife", "husband", "spouse", "partner", "girlfriend", "boyfriend", "fiance", "fiancee",
    "significant other", "kids", "children", "family", "married", "relationship",
    "long distance",
)
PARTNER_EXTRA_TERMS = ("so",)

FACULTY_TERMS = (
    "attending", "faculty", "program director", "chair", "chief",
    "associate program director", "department chair",
)
FACULTY_EXTRA_TERMS = ("pd", "apd")

ATTRITION_TERMS = (
    "quit", "quitting", "left", "leaving", "moved away", "moving back", "burned out",
    "burnout", "burnt out", "resign", "resigned", "transferred", "couldn't stay",
    "had to leave", "forced to leave", "regret", "mistake", "worst decision", "should have",
    "wish I had", "never should have", "don't go", "wouldn't recommend",
    "finished my contract", "contract ended", "buyout", "non-compete", "3 year commitment",
    "2 years and left", "left after NHSC", "escape", "get out", "couldn't wait to leave",
    "counting down", "trapped", "stuck", "prison", "sentence",
)

PII_WHITELIST = (
    "dr. house", "grey's anatomy", "scrubs", "er", "the resident", "dr. cox", "dr. grey",
    "dr. shepherd", "meredith", "mcdreamy", "house md", "chicago med", "new amsterdam",
    "the good doctor", "doogie howser", "patch adams", "dr. strange",
)

CUSTOM_STOP_WORDS = (
    "doc", "doctor", "med", "medical", "student", "resident", "residency", "hospital",
    "patient", "people", "get", "like", "one", "would", "know", "think", "go", "time",
    "year", "program", "match", "make", "really", "deleted", "removed", "amp", "x200b",
    "https", "com", "www", "reddit", "http", "org", "edu", "just", "also", "much", "even",
    "well", "back",
)

# The usual English function-word list, contractions and their halves included.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until
while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why
how all any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren aren't
couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma
mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren
weren't won won't wouldn wouldn't
""".split())
# --- End of fixed values ----------------------------------------------------

# Accent-free function words, since cleaning deletes accented letters.
LANGUAGE_WORDS: Mapping[str, tuple[str, ...]] = MappingProxyType({
    "en": tuple("the and of to in is was that for with as on by at from are this be or an it "
                "not but have which".split()),
    "de": tuple("der die das und ist nicht ein eine mit von zu den dem auf im des sich auch "
                "es bei wird nach aus war sind".split()),
    "es": tuple("el la los las y de que en un una por con para es del al se su como pero lo "
                "no este esta son".split()),
    "fr": tuple("le la les et des est un une dans que qui pour sur pas avec ce par plus au du "
                "en il elle ne sont".split()),
})

POSITIVE_WORDS = tuple("""
amazing awesome best better brilliant enjoy enjoyed excellent excited fantastic friendly fun
glad good grateful great happy helpful incredible kind love loved lovely nice perfect pleased
positive proud recommend rewarding satisfied supportive thankful thrilled welcoming wonderful
worth
""".split())

NEGATIVE_WORDS = tuple("""
abusive afraid alone angry awful bad boring brutal burnout cruel depressed depressing dread
exhausted exhausting frustrated hate hated hates horrible hostile isolated lonely malignant
miserable mistake nightmare overworked pain quit regret sad scared stuck suffer terrible tired
toxic trapped unhappy unsafe useless worse worst wrong
""".split())

GIVEN_NAMES = tuple("""
Aaron Adam Alan Albert Alice Amanda Amy Andrea Andrew Angela Anna Anthony Ashley Barbara
Benjamin Betty Brandon Brian Carol Catherine Charles Christine Christopher Cynthia Daniel
David Deborah Dennis Diana Donald Donna Dorothy Edward Elizabeth Emily Emma Eric Frank Gary
George Gregory Hannah Heather Helen Jack Jacob James Janet Jason Jeffrey Jennifer Jessica Joan
John Jonathan Joseph Joshua Julia Julie Karen Katherine Kathleen Kenneth Kevin Kimberly Larry
Laura Linda Lisa Margaret Maria Mark Martha Mary Matthew Megan Melissa Michael Michelle Nancy
Nicholas Nicole Olivia Pamela Patricia Patrick Paul Peter Rachel Raymond Rebecca Richard Robert
Ronald Ruth Ryan Samantha Samuel Sandra Sarah Scott Sharon Stephanie Stephen Steven Susan Teresa
Thomas Timothy Tyler Victoria Virginia William Zachary
""".split())

PLACE_NAMES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas",
    "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York City", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota",
    "Tennessee", "Texas", "Utah", "Vermont", "Washington", "West Virginia", "Wisconsin",
    "Wyoming", "Atlanta", "Austin", "Baltimore", "Bend", "Boise", "Boston", "Chicago",
    "Cleveland", "Corvallis", "Dallas", "Denver", "Detroit", "Eugene", "Houston", "Las Vegas",
    "Los Angeles", "Medford", "Miami", "Minneapolis", "Nashville", "New Orleans", "Philadelphia",
    "Phoenix", "Pittsburgh", "Portland", "Sacramento", "Salem", "Salt Lake City", "San Antonio",
    "San Diego", "San Francisco", "Seattle", "Spokane", "Tucson", "Australia", "Brazil",
    "Canada", "China", "France", "Germany", "India", "Ireland", "Italy", "Japan", "Mexico",
    "Nigeria", "Pakistan", "Philippines", "Spain", "United Kingdom", "United States",
)

DELETED_MARKERS = ("[deleted]", "[removed]", "")


@dataclass(frozen=True)
class Settings:
    """All parameters of the operators. Defaults reproduce the documented results."""

    # text
    deleted_markers: tuple[str, ...] = DELETED_MARKERS
    min_text_length: int = 15
    max_char_length: int = 2000
    supported_languages: tuple[str, ...] = ("en",)
    language_words: Mapping[str, tuple[str, ...]] = LANGUAGE_WORDS
    relevance_terms: tuple[str, ...] = RELEVANCE_TERMS
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS
    custom_stop_words: tuple[str, ...] = CUSTOM_STOP_WORDS

    # keywords
    search_terms: Mapping[str, tuple[str, ...]] = SEARCH_TERMS
    region_terms: tuple[str, ...] = REGION_TERMS
    partner_terms: tuple[str, ...] = PARTNER_TERMS
    partner_extra_terms: tuple[str, ...] = PARTNER_EXTRA_TERMS
    faculty_terms: tuple[str, ...] = FACULTY_TERMS
    faculty_extra_terms: tuple[str, ...] = FACULTY_EXTRA_TERMS
    attrition_terms: tuple[str, ...] = ATTRITION_TERMS
    normalize_keywords: bool = False

    # sentiment
    sentiment_model: str = "lexicon"
    positive_words: tuple[str, ...] = POSITIVE_WORDS
    negative_words: tuple[str, ...] = NEGATIVE_WORDS
    confidence_threshold: float = 0.7

    # personal data
    pii_action: str = "redact"  # redact | flag | none
    pii_entities: tuple[str, ...] = (
        "PERSON", "PHONE_NUMBER", "EMAIL_ADDRESS", "LOCATION", "DATE_TIME")
    pii_whitelist: tuple[str, ...] = PII_WHITELIST
    pii_whitelist_match: str = "substring"  # substring | word
    given_names: tuple[str, ...] = GIVEN_NAMES
    place_names: tuple[str, ...] = PLACE_NAMES

    # topics
    enable_topics: bool = True
    topic_min_rows: int = 50
    topic_seed: int = 42
    topic_top_words: int = 10

    # aggregates and outputs
    enable_rolling: bool = True
    output_timezone: str = "America/Los_Angeles"
    negative_min_rows: int = 5
    negative_max_terms: int = 50
    min_results: int = 10
    backfill_months: int = 24
    version: str = "v1.0"

    # deep analysis
    deep_posts: int = 500
    deep_threshold: float = -0.3
    deep_batch_size: int = 10
    deep_text_chars: int = 1500


DEFAULT = Settings()
