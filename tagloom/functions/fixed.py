"""Fixed values that results depend on."""

# Tiers of quality as integers, and of a classifier's labels.
TIER_NUMBER = {"worse_score": 0, "bad_score": 1, "good_score": 2, "masterpiece": 3}
LABEL_NUMBER = {"worst": 0, "worse": 1, "better": 2, "best": 3}

# Rating letters.
RATINGS = {"e": "explicit", "q": "questionable", "s": "sensitive", "g": "general"}

# Tags of quality that lower or raise a post's tier, matched as parts of the tag string.
NEGATIVE_TAGS = (
    "bad_anatomy", "bad_hands", "bad_feet", "bad_perspective", "english_text", "bad_proportions", "extra_digits", "lowres", "jpeg_artifacts", "blurry", "low_quality", "worst_quality",
    "gif_artifacts", "corrupted_file", "watermark", "banned_artist", "error", "cropped", "bad_aspect_ratio", "scan_artifacts", "scan_dust", "adversarial_noise",
)
POSITIVE_TAGS = ("highres", "absurdres", "ultra-detailed", "official_art", "novel_illustration", "official_wallpaper", "incredibly_absurdres", "key_visual", "promotional_art")

# Meta tags that prompts repeat.
META_TAGS = ("highres", "absurdres", "ultra-detailed", "official_art", "novel_illustration", "official_wallpaper")

# Synonyms of the tiers in prompts; the last of each always stands.
QUALITY_SYNONYMS = {
    "masterpiece": ("best quality", "very aesthetic"),
    "good score": ("amazing quality", "great quality", "aesthetic"),
    "bad score": ("normal quality", "bad quality", "displeasing"),
    "worse score": ("worst quality", "very displeasing"),
}

# Attributes of which a character has one.
HAIR_LENGTHS = ("long hair", "medium hair", "short hair", "very long hair", "very short hair", "absurdly long hair")
EYE_COLORS = (
    "blue eyes", "red eyes", "brown eyes", "green eyes", "purple eyes", "yellow eyes", "pink eyes", "black eyes", "aqua eyes", "orange eyes", "grey eyes", "silver eyes", "white eyes", "multicolored eyes",
)
HAIR_COLORS = (
    "blonde hair", "brown hair", "black hair", "blue hair", "purple hair", "pink hair", "red hair", "white hair", "green hair", "grey hair", "orange hair", "silver hair", "aqua hair", "multicolored hair",
    "two-tone hair",
)

# Words that exclude others. Keys are compared with single words of a prompt, so a key of two words would
# never be met and is not listed.
CONFLICTS = {"bikini": ("panties", "shorts", "bra"), "swimsuit": ("panties", "shorts"), "bra": ("bikini",)}

# Token ids of prompt tokenizers.
BOS, EOS, COMMA, BRACKET_COMMA, MAX_TOKENS = 49406, 49407, 267, 2361, 227
LENGTH_TIERS = (77, 152, 227)

# Words of meta tags that leave a post out of a face set.
FACE_META = ("animated", "duplicate", "pixel-perfect_duplicate", "lowres", "watermark")

# Clusters of general tags, first match wins in this order.
TAG_CLUSTERS = {
    "Body Features": ("breasts", "thighs", "hair", "eyes", "skin", "ass", "navel", "legs", "feet", "face"),
    "Clothing": ("skirt", "dress", "uniform", "swimsuit", "bra", "panties", "sailor_suit", "school_uniform", "bikini", "socks", "shirt"),
    "Accessories": ("ribbon", "hat", "jewelry", "glasses", "hair_ornament", "halo", "wings", "gloves", "necklace"),
    "Actions/Poses": ("lying", "sitting", "standing", "looking_at_viewer", "on_back", "spread_legs", "from_behind", "posing", "holding"),
    "Environment": ("outdoors", "indoors", "sky", "water", "night", "bed", "room", "city", "background", "simple_background"),
    "Explicit/Rating": ("nsfw", "nipples", "pussy", "nude", "sex"),
}
# Tags that count persons.
PERSON_TAGS = ("1girl", "2girls", "3girls", "4girls", "5girls", "6+girls", "1boy", "2boys", "3boys", "4boys", "5boys", "6+boys", "multiple_girls", "multiple_boys", "group", "solo")
