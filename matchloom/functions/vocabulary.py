"""Fixed values of the name functions: word lists, synonyms, patterns and thresholds."""

# Letters that are spaced out, and the words after a number of bedrooms.
SPACED_LETTERS = r"\b(?:[A-Za-z]\s){2,}[A-Za-z]\b"
BEDROOM_WORDS = r"\s*(?:bed\s?rooms?|br|bhk)\b"
# Board and rate codes that trail a name.
BOARD_CODES = "ro bb hb fb ai nr nrro nrbb nrhb nrfb nrb rf rfro rfbb".split()
# Words that say nothing about which room it is.
FILLER = "room rooms".split()
# Words of rates, promotions and perks.
RATE_WORDS = "refundable nonrefundable non smoking nonsmoking breakfast package prepaid cancellation rate rateplan plan included inclusive advance saver".split()
PROMO_WORDS = (
    "summer winter spring autumn deal deals offer offers special promo promotion discount save savings sale flash limited valid until "
    "complimentary voucher bonus gift early bird january february march april may june july august september october november december"
).split()
PERK_WORDS = (
    "lounge access afternoon tea soft beverages beverage evening sundowners canapes snacks happy hour butler concierge privileges benefits "
    "wifi parking transfer shuttle free drinks welcome amenity amenities"
).split()
# From the first of these words on (but not at the start) a name is advertising.
PROMO_STARTS = "off valid including includes complimentary save discount promo offer offers deal deals upto worth voucher".split()
# Abbreviations, words written apart, sizes and years.
ABBREVIATIONS = {"dlx": "deluxe", "std": "standard", "sgl": "single", "dbl": "double", "twn": "twin", "apt": "apartment", "exec": "executive"}
SPLIT_WORDS = ((r"\bde\s+luxe\b", "deluxe"), (r"\bsea\s+view\b", "seaview"), (r"\bnon\s+smoking\b", "nonsmoking"), (r"\bbed\s+room\b", "bedroom"))
DIMENSION = r"^\d+(?:sm|sf|sqm|sqft|m2|sqm\.|sf\.)$"
YEAR = r"^(?:19|20)\d\d$"
# What makes "access" mean step-free access.
DISABILITY = "disabled disability wheelchair mobility handicap handicapped ada adapted".split()
DISABILITY_PHRASE = r"\bspecial(?:ly)?\s+(?:needs?|abled)\b|\bhandicap(?:ped)?\b|\bwheel\s*chair\b"
ACCESS_WORDS = "access accessible accessibility".split()
ACCESSIBILITY = "accessible disabled mobility handicap wheelchair ada".split()
# What a name can state about a room.
CLASSES = ("presidential suite", "junior suite", "penthouse", "villa", "suite", "studio", "apartment", "chalet", "bungalow", "dormitory", "room")
BEDS = "king queen twin double single bunk sofa".split()
TIERS = (
    "presidential premiere premier premium executive signature superior standard business economy comfort classic upgraded luxury deluxe "
    "select budget grand club basic plus elite prestige royal imperial platinum prime exclusive privilege value essential preferred ultra"
).split()
# Tiers that count as another.
TIER_SYNONYMS = {
    "premiere": "premier", "premium": "premier",
    "classic": "standard", "basic": "standard", "essential": "standard", "value": "standard", "budget": "standard", "economy": "standard",
    "luxe": "deluxe", "luxury": "deluxe",
}
# Words that two rooms may share without it meaning anything.
GENERIC = sorted(
    {*CLASSES, *BEDS, *FILLER, *"bed beds size full with and or the a an of in view views bedroom bedrooms 1 2 3 4 5 one two three four five large small new use".split()}
)
# Where a view's name ends, number words, words that tell buildings apart, connectors of country names.
VIEW_STOPS = sorted({*"with and a the of or".split(), *CLASSES, *BEDS, *TIERS, *ACCESSIBILITY})
NUMBERS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10}
COMPASS = "north south east west northeast northwest southeast southwest".split()
NAME_CONNECTORS = "and the of des del dos das der den und les los las van bin sur".split()

# The taxonomy, in order of precedence; the bedroom counts stand before "Apartment".
CATEGORY_RULES = (
    ("Overwater Villa", r"overwater|over water|water villa"),
    ("Villa", r"\bvillas?\b"),
    ("Penthouse", r"\bpent\s?house\b"),
    ("Presidential Suite", r"presidential|royal suite|ambassador|imperial"),
    ("Executive Suite", r"\b(?:executive|exec|business|club)\s+suite\b"),
    ("Junior Suite", r"\b(?:junior|jr|mini|semi)\s+suite\b"),
    ("Suite", r"\bsuites?\b"),
    ("Dormitory", r"\bdorms?\b|dormitory|shared room|\bbed in\b"),
    ("Studio", r"\bstudios?\b"),
    ("Apartment", r"\bapart(?:ment|hotel)s?\b|\bresidences?\b|\bflats?\b"),
    ("Chalet", r"\bchalets?\b|\bcabins?\b|\bcottages?\b|\blodges?\b"),
    ("Bungalow", r"\bbungalows?\b|\bpavilions?\b"),
    ("Accessible Room", r"accessible|disabled|mobility|handicap"),
    ("Family Room", r"\bfamily\b|\btriple\b|\bquadruple\b|\bquad\b"),
    ("Club Room", r"\bclubs?\b|\bclb\b|concierge|lounge access"),
    ("Executive Room", r"\bexecutives?\b|\bexec\b"),
    ("Premium Room", r"\bpremium\b|\bpremier\b|\bgrand\b"),
    ("Deluxe Room", r"\bdeluxe\b|\bde luxe\b|\bdlx\b"),
    ("Superior Room", r"\bsuperior\b"),
    ("Standard Room", r"\bstandard\b|\bclassic\b|\bbasic\b|\beconomy\b|\bbudget\b|run of house|\broh\b|\bstd\b"),
)
# Categories by number of bedrooms, and for whatever no rule knows.
BEDROOM_CATEGORIES = ("One Bedroom Apartment", "Two Bedroom Apartment", "Three Bedroom Apartment", "Multi Bedroom Apartment")
FALLBACK_CATEGORY = "General"

# Thresholds.
ACCEPT, REVIEW, ACCESS_CAP = 75.0, 62.0, 74.0
NEAR_KM, FAR_KM = 0.35, 1.5
NAME_FLOOR, NAME_STRONG, NAME_STRICT, SAME_LISTING = 72.0, 90.0, 88.0, 90.0
CANDIDATES_B, CANDIDATES_C = 5, 3
VERIFIED_SCORE, VERIFIED_KM = 90.0, 0.25
IMAGES_PER_ROOM, NAME_LENGTH, REASON_LENGTH, LEAST_IMAGE_BYTES = 15, 191, 300, 4096
FRESH_DAYS, STALE_DAYS = 7, 365
ROTATE_AFTER, DEGRADED_AFTER, FLAT_STOP = 3, 8, 2
# Weeks ahead, adults and nights of each rung.
BASE_LADDER = ((1, 2, 1), (1, 1, 1), (2, 2, 1), (2, 1, 1), (3, 2, 1), (1, 2, 2))
WIDER_LADDER = ((4, 2, 1), (6, 2, 1), (8, 2, 1), (1, 3, 1), (2, 2, 3), (1, 2, 7), (4, 1, 2), (12, 2, 1))
MIDWEEK_DAYS = 3
