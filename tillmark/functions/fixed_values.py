"""Fixed values. Results depend on these words, numbers and patterns being exactly so."""

# Characters removed by a text strip: every Unicode white-space character.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Unit words and what they are counted in.
WEIGHT_UNITS = {"mg": 0.001, "g": 1.0, "kg": 1000.0}  # grams
VOLUME_UNITS = {"ml": 1.0, "millilitre": 1.0, "l": 1000.0, "litre": 1000.0, "liter": 1000.0}
COUNT_WORDS = (
    "each", "ea", "tablet", "tablets", "capsule", "capsules",
    "pack", "pk", "sheet", "sheets", "wash", "washes", "serve",
    "serves", "unit", "units", "item", "items", "piece", "pieces",
)

# Texts that stand for an empty cell.
EMPTY_WORDS = ("nan", "none", "null")
EMPTY_LISTS = ("[]", "nan", "None", "null")

# Texts of a specials cell that mean "not on special".
NOT_SPECIAL_WORDS = ("nan", "none", "null", "false", "0", "no", "f", "n")

AVAILABILITY = {
    "available": "available",
    "in stock": "available",
    "instock": "available",
    "unavailable": "unavailable",
    "out of stock": "unavailable",
    "sold out": "unavailable",
}

# Category text (lower case) -> level 1, level 2.
TAXONOMY = (
    ("fruit-vegetables", "Fresh Food", "Fruit & Vegetables"),
    ("fruit-&-veg", "Fresh Food", "Fruit & Vegetables"),
    ("fruit & veg", "Fresh Food", "Fruit & Vegetables"),
    ("fruit", "Fresh Food", "Fruit & Vegetables"),
    ("fruit vegetables", "Fresh Food", "Fruit & Vegetables"),
    ("bakery", "Fresh Food", "Bakery"),
    ("dairy-eggs-fridge", "Fresh Food", "Dairy, Eggs & Fridge"),
    ("dairy eggs & fridge", "Fresh Food", "Dairy, Eggs & Fridge"),
    ("dairy eggs fridge", "Fresh Food", "Dairy, Eggs & Fridge"),
    ("fresh product", "Fresh Food", "Dairy, Eggs & Fridge"),
    ("meat-seafood", "Fresh Food", "Meat & Seafood"),
    ("meat seafood & deli", "Fresh Food", "Meat & Seafood"),
    ("meat seafood deli", "Fresh Food", "Meat & Seafood"),
    ("deli", "Fresh Food", "Meat & Seafood"),
    ("drinks", "Drinks", "Drinks"),
    ("soft-drinks", "Drinks", "Soft Drinks"),
    ("soft drinks", "Drinks", "Soft Drinks"),
    ("beer wine spirits", "Drinks", "Beer, Wine & Spirits"),
    ("health-beauty", "Health & Beauty", "Health & Beauty"),
    ("health beauty", "Health & Beauty", "Health & Beauty"),
    ("health & beauty", "Health & Beauty", "Health & Beauty"),
    ("health", "Health & Beauty", "Health"),
    ("beauty", "Health & Beauty", "Health & Beauty"),
    ("personal care", "Health & Beauty", "Personal Care"),
    ("groceries", "Pantry", "Groceries"),
    ("pantry", "Pantry", "Pantry"),
    ("international foods", "Pantry", "International Foods"),
    ("biscuits snacks", "Pantry", "Biscuits & Snacks"),
    ("snacks", "Pantry", "Biscuits & Snacks"),
    ("frozen", "Frozen", "Frozen"),
    ("freezer", "Frozen", "Frozen"),
    ("household", "Household", "Household"),
    ("laundry household", "Household", "Household"),
    ("laundry", "Household", "Laundry"),
    ("cleaning", "Household", "Cleaning"),
    ("baby", "Baby", "Baby"),
    ("pet", "Pet", "Pet"),
)
OTHER_CATEGORY = "Other"

# Sub-category slugs of the feed without a usable main category.
SLUG_CATEGORIES = {
    "fresh product": "Dairy Eggs & Fridge",
    "beauty": "Health & Beauty",
    "health": "Health & Beauty",
    "laundry household": "Household",
    "freezer": "Frozen",
}

# Department names that carry a comma, and their spelling without it.
COMMA_DEPARTMENTS = {
    "Meat, Seafood & Deli": "Meat Seafood & Deli",
    "Dairy, Eggs & Fridge": "Dairy Eggs & Fridge",
}
EXCLUDED_DEPARTMENTS = ("Tobacco Product", "Liquor")
NO_DEPARTMENT = "NOT LISTED"
EXCLUDED_CATEGORY = "Liquor"

# Quality rules.
VALID_RETAILERS = ("Aldi", "Coles", "IGA", "Woolworths")
PRICE_MIN = 0.0
PRICE_MAX = 1000.0
UNIT_PRICE_TOLERANCE = 100.0

# Retailer reference rows: retailer, parent company, type.
RETAILERS = (
    ("Aldi", "ALDI Australia", "Discounter"),
    ("Coles", "Coles Group", "Full-service"),
    ("IGA", "Metcash (IGA)", "Independent"),
    ("Woolworths", "Woolworths Group", "Full-service"),
)

# Parts of a file name, tried in this order, and the folder they lead to.
FILE_NAME_MARKS = (
    ("aldi", "aldi"),
    ("coles", "coles"),
    ("iga", "iga"),
    ("wow", "woolworths"),
    ("woolworths", "woolworths"),
)
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"
FOLDER_DATE = r"date=(\d{4}-\d{2}-\d{2})"

# Characters a stored column name may not contain.
NAME_BREAKERS = r"[ ,;{}()\n\t=]+"
