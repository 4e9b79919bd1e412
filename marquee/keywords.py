"""Keyword dimension for categories: ordered blocks of (category, keywords).

The blocks are a parameter of every operator that uses them; a caller may pass
any other list in the same shape.
"""

from __future__ import annotations

# English category keywords, first block with a hit wins.
ENGLISH = [
    ("Food & Drink", [
        "food", "drink", "cooking", "chef", "cuisine", "tasting", "brewery", "wine", "beer", "cocktail",
        "dinner", "lunch", "brunch", "restaurant", "culinary", "cheese", "pizza", "taco", "ice cream",
        "chocolate", "bakery", "pastry", "coffee", "tea", "mixology", "dining", "bake", "baking", "supper",
        "feast", "foodie", "noodles", "sushi", "vegan", "vegetarian", "pickle", "farfalle",
        "cooking class", "food tour", "steak dinner", "bar", "dessert", "gourmet",
    ]),
    ("Music", [
        "concert", "live music", "band", "dj", "festival", "gig", "show", "music", "acoustic",
        "electronic", "rock", "jazz", "hip hop", "rap", "indie", "pop", "classical", "opera", "symphony",
        "orchestra", "karaoke", "open mic", "session", "vinyl", "record", "album", "reggaeton", "cumbia",
        "salsa", "banda", "norteño", "corrido", "mariachi", "ranchera", "banda sinaloense", "grupero",
    ]),
    ("Arts & Theatre", [
        "theatre", "theater", "play", "musical", "opera", "ballet", "dance", "comedy", "improv",
        "standup", "stand-up", "performance", "art", "exhibition", "gallery", "museum", "workshop",
        "class", "course", "painting", "drawing", "sculpture", "photography", "film", "cinema",
    ]),
    ("Sports & Fitness", [
        "sport", "fitness", "yoga", "running", "marathon", "cycling", "hiking", "climbing", "swimming",
        "gym", "workout", "training", "bootcamp", "crossfit", "pilates", "martial arts", "boxing", "mma",
        "wrestling", "soccer", "football", "basketball", "baseball", "tennis", "golf",
    ]),
    ("Nightlife", [
        "club", "nightclub", "bar", "pub", "lounge", "rooftop", "speakeasy", "afterparty", "after-party",
        "late night", "dance", "edm", "techno", "house", "trance", "dnb", "drum and bass", "reggaeton",
        "perreo",
    ]),
    ("Tech & Business", [
        "tech", "technology", "startup", "business", "networking", "conference", "workshop", "meetup",
        "hackathon", "coding", "programming", "ai", "machine learning", "data science", "blockchain",
        "crypto", "fintech",
    ]),
    ("Health & Wellness", [
        "health", "wellness", "meditation", "mindfulness", "therapy", "counseling", "psychology",
        "mental health", "spa", "massage", "holistic", "alternative medicine", "herbal", "naturopathy",
    ]),
    ("Travel & Outdoor", [
        "travel", "tour", "hiking", "camping", "backpacking", "adventure", "excursion", "day trip",
        "weekend getaway", "road trip", "vanlife",
    ]),
    ("Community & Social", [
        "community", "social", "meetup", "gathering", "volunteer", "charity", "fundraiser", "nonprofit",
        "ngo", "activism", "protest", "march", "community service", "neighborhood",
    ]),
    ("Family & Kids", [
        "kids", "children", "family", "infantil", "niños", "niñas", "familia", "kinder", "guardería",
        "taller infantil", "cuentacuentos", "payaso",
    ]),
]

# Keywords the Spanish list adds to the English blocks, the English
# keywords it leaves out, its own block, and the order of its blocks.
SPANISH_ADDED = {
    "Food & Drink": ["mezcal", "tequila", "taco tour", "mercado"],
    "Arts & Theatre": ["teatro", "obra", "monólogo", "stand up", "improvisación"],
    "Sports & Fitness": ["futbol", "fútbol", "ciclismo", "senderismo", "escalada"],
    "Nightlife": ["antro", "discoteca", "barra", "cantina", "mezcalería"],
    "Tech & Business": ["emprendimiento", "networking", "conferencia", "taller"],
    "Health & Wellness": ["meditación", "mindfulness", "terapia", "psicología", "spa"],
    "Travel & Outdoor": ["senderismo", "camping", "excursión", "viaje", "tour", "aventura"],
    "Community & Social": ["vecindario", "comunitario", "voluntariado", "beneficencia", "recaudación"],
}
SPANISH_LEFT_OUT = {"Food & Drink": ["dessert", "gourmet"]}
SPANISH_KITCHEN = ("Food & Drink", [
    "taco", "taquería", "tortilla", "quesadilla", "tostada", "tamal", "pozole", "menudo", "birria",
    "carnitas", "al pastor", "chorizo", "chilaquiles", "enchilada", "mole", "salsa", "guacamole",
    "ceviche", "aguachile", "tostada", "gordita", "sope", "huarache", "tlacoyo",
])
SPANISH_ORDER = [
    "Food & Drink", "Music", "Arts & Theatre", "Sports & Fitness", "Nightlife", SPANISH_KITCHEN,
    "Family & Kids", "Tech & Business", "Health & Wellness", "Travel & Outdoor", "Community & Social",
]


def spanish() -> list[tuple[str, list[str]]]:
    """The Spanish-extended blocks, derived from the English ones."""
    english = dict(ENGLISH)
    blocks = []
    for entry in SPANISH_ORDER:
        if isinstance(entry, tuple):
            blocks.append(entry)
            continue
        left_out = SPANISH_LEFT_OUT.get(entry, [])
        blocks.append((entry, [k for k in english[entry] if k not in left_out] + SPANISH_ADDED.get(entry, [])))
    return blocks


def decisive(keywords: list[str]) -> list[str]:
    """Keywords of one block that no shorter keyword of the block already implies."""
    low = [k.lower() for k in dict.fromkeys(keywords)]
    return [k for k in low if not any(o != k and o in k for o in low)]
