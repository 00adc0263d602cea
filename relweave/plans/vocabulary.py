"""Fixed values of the data model: attribute names, dictionary keys, phrases and lookup rows."""

from __future__ import annotations

from relweave.operators.relational import DAYS  # noqa: F401  (weekday order of the hours columns)

# Attributes holding 'True' / 'False' / 'None' text (fixed values).
BOOLEAN_ATTRIBUTES = (
    "AcceptsInsurance", "BYOB", "BikeParking", "BusinessAcceptsBitcoin", "BusinessAcceptsCreditCards",
    "ByAppointmentOnly", "Caters", "CoatCheck", "Corkage", "DogsAllowed", "DriveThru", "GoodForDancing",
    "GoodForKids", "HappyHour", "HasTV", "Open24Hours", "OutdoorSeating", "RestaurantsCounterService",
    "RestaurantsDelivery", "RestaurantsGoodForGroups", "RestaurantsReservations",
    "RestaurantsTableService", "RestaurantsTakeOut", "WheelchairAccessible",
)

# Attributes holding quoted text, with the longest cleaned value (fixed values).
TEXT_ATTRIBUTES = {
    "AgesAllowed": 7, "Alcohol": 13, "BYOBCorkage": 11, "NoiseLevel": 9, "RestaurantsAttire": 6,
    "Smoking": 7, "WiFi": 4,
}

# Attributes holding whole numbers (fixed values).
INTEGER_ATTRIBUTES = ("RestaurantsPriceRange2",)

# Attributes holding a dictionary of flags, with the keys in the source text (fixed values).
FLAG_ATTRIBUTES = {
    "Ambience": ("romantic", "casual", "trendy", "intimate", "hipster", "upscale", "divey", "touristy", "classy"),
    "BestNights": ("sunday", "thursday", "monday", "wednesday", "saturday", "friday", "tuesday"),
    "BusinessParking": ("valet", "lot", "validated", "garage", "street"),
    "DietaryRestrictions": ("kosher", "dairy-free", "vegan", "vegetarian", "gluten-free", "soy-free", "halal"),
    "GoodForMeal": ("lunch", "brunch", "dinner", "latenight", "dessert", "breakfast"),
    "HairSpecializesIn": (
        "curly", "asian", "perms", "africanamerican", "straightperms", "kids", "coloring", "extensions",
    ),
    "Music": ("no_music", "dj", "live", "karaoke", "video", "background_music", "jukebox"),
}

# Category names that contain the list delimiter (fixed values).
PROTECTED_CATEGORIES = ("Wills, Trusts, & Probates",)

# Population groups of the demographics source, as column names (fixed values).
POPULATION_GROUPS = (
    "american_indian_and_alaska_native", "asian", "black_or_african_american", "hispanic_or_latino", "white",
)

# State of the cities in the weather source, which names cities only (fixed values).
WEATHER_CITIES = (
    ("Phoenix", "AZ"), ("Dallas", "TX"), ("Los Angeles", "CA"), ("San Diego", "CA"), ("Pittsburgh", "PA"),
    ("Las Vegas", "NV"), ("Seattle", "WA"), ("New York", "NY"), ("Charlotte", "NC"), ("Denver", "CO"),
    ("Boston", "MA"),
)
WEATHER_COUNTRY = "United States"
