"""Labels, lookups and limits that results depend on, stated as plain data."""

# --- Fixed values: order status of the source file -> shop status ---------------------------
STATUS_LABELS = {
    "delivered": "completed",
    "shipped": "completed",
    "approved": "pending",
    "processing": "pending",
    "invoiced": "pending",
    "created": "pending",
    "canceled": "cancelled",
    "unavailable": "cancelled",
}
DEFAULT_STATUS = "pending"
SHOP_STATUSES = ("completed", "pending", "cancelled")

# --- Fixed values: English category name -> shop category group ----------------------------
CATEGORY_GROUPS = {
    "Electronics": (
        "computers_accessories", "electronics", "computers", "telephony", "tablets_printing_image",
        "audio", "watches_gifts", "consoles_games", "fixed_telephony", "small_appliances",
        "small_appliances_home_oven_and_coffee", "air_conditioning", "home_appliances",
        "home_appliances_2", "pc_gamer", "security_and_services", "signaling_and_security",
    ),
    "Clothing": (
        "fashion_bags_accessories", "fashio_female_clothing", "fashion_male_clothing",
        "fashion_shoes", "fashion_underwear_beach", "fashion_sport", "fashion_childrens_clothes",
        "luggage_accessories",
    ),
    "Food & Beverage": ("food_drink", "food", "drinks"),
    "Books": (
        "books_general_interest", "books_technical", "books_imported", "cds_dvds_musicals",
        "dvds_blu_ray", "music",
    ),
    "Sports": ("sports_leisure", "la_cuisine"),
    "Beauty": ("health_beauty", "perfumery", "diapers_and_hygiene"),
    "Home & Living": (
        "furniture_decor", "furniture_living_room", "furniture_bedroom",
        "furniture_mattress_and_upholstery", "furniture_office", "bed_bath_table", "housewares",
        "garden_tools", "construction_tools_construction", "construction_tools_safety",
        "construction_tools_lights", "costruction_tools_garden", "home_confort", "home_comfort_2",
        "kitchen_dining_laundry_garden_furniture", "office_furniture", "christmas_supplies",
        "flowers", "market_place", "industry_commerce_and_business", "agro_industry_and_commerce",
        "party_supplies", "art", "arts_and_craftmanship", "toys", "baby", "stationery",
        "musical_instruments", "cool_stuff", "auto", "pet_shop",
        "portable_kitchen_food_processors",
    ),
}
DEFAULT_CATEGORY = "Home & Living"

# --- Fixed values: age limits ----------------------------------------------------------------
AGE_BANDS = ((18, 24), (25, 34), (35, 44), (45, 54))
OLDEST_BAND = "55+"
AGE_MIN, AGE_MAX = 16, 100
DERIVED_AGE_MIN, DERIVED_AGE_MAX = 18, 65

# --- Fixed values: reasons written beside rejected rows --------------------------------------
REASON_NAME = "Missing or empty full name"
REASON_EMAIL = "Invalid email format"
REASON_AGE = "Age out of range (16-100)"
REASON_COST = "Invalid cost price"
REASON_SELL = "Invalid sell price"
REASON_BELOW_COST = "Sell price below cost"
REASON_QUANTITY = "Invalid quantity"
REASON_UNIT_PRICE = "Invalid unit price"
REASON_STATUS = "Unknown status"
REASON_NO_CUSTOMER = "Customer not found"
REASON_NO_PRODUCT = "Product not found"

# --- Fixed values: derived customer text and product prices -----------------------------------
NAME_PREFIX, NAME_ID_CHARS = "Customer ", 8
EMAIL_ID_CHARS, EMAIL_SUFFIX = 12, "@olist.example.com"
UNKNOWN_TEXT = "Unknown"
COST_SHARE = "0.55"

# --- Fixed values: file names of the public shop data set, and run defaults -------------------
SOURCE_FILES = {
    "customers": "olist_customers_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "products": "olist_products_dataset.csv",
    "translation": "product_category_name_translation.csv",
}
DEFAULT_SEED = 42
DEFAULT_DAILY_ORDERS = 250
DEFAULT_LOOKBACK_DAYS = 3

# --- Fixed values: punctuation that starts a new word in SQL INITCAP (besides blanks) ---------
INITCAP_BREAKS = "[](){}/|<>!?@\"^#$&~_,.:;*%+-"

# --- Fixed values: cell texts that CSV readers of the pandas family take as missing -----------
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
