"""Product attributes read from names and numbers, taxes and unit prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bottle sizes in millilitres that the trade uses.
BOTTLES = (50, 100, 187, 200, 250, 330, 355, 375, 473, 500, 700, 720, 750, 1000, 1500, 1750, 3000)
#: Classes by pattern, the first that matches counts.
CLASSES = (
    ("non-alcoholic", r"\b(non[- ]?alc|alcohol[- ]free|0\.0%)"),
    ("wine", r"\b(wine|cabernet|merlot|chardonnay|pinot|prosecco|champagne|rose)\b"),
    ("beer", r"\b(beer|ale|lager|stout|ipa|pilsner|porter)\b"),
    ("whiskey", r"\b(whiske?y|bourbon|rye|scotch)\b"),
    ("spirits", r"\b(vodka|gin|rum|tequila|mezcal|brandy|cognac|liqueur)\b"),
)


def size_bucket(ml: Column, tolerance: float = 0.03, sizes: tuple[int, ...] = BOTTLES) -> Column:
    """The nearest size within the tolerance, the smaller of equals; null beyond it."""
    grid = F.array(*[F.lit(float(s)) for s in sizes])
    gaps = F.transform(grid, lambda s: F.abs(s - ml))
    nearest = F.element_at(grid, F.array_position(gaps, F.array_min(gaps)).cast("int"))
    return F.when(F.abs(nearest - ml) <= tolerance * nearest, nearest.cast("int"))


def pack_count(name: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(name), r"([0-9]+) ?(?:pk|pack|ct)\b", 1), F.lit("")).try_cast("int"), F.lit(1))


def abv(name: Column) -> Column:
    """Alcohol by volume from a percentage, or from proof by halves; null outside 0 to 96."""
    percent = F.regexp_extract(name, r"([0-9]+(?:\.[0-9]+)?) ?%", 1).try_cast("double")
    proof = F.regexp_extract(F.lower(name), r"([0-9]+(?:\.[0-9]+)?) ?(?:proof|pf)\b", 1).try_cast("double") / 2
    value = F.coalesce(percent, proof)
    return F.when(value.between(0, 96), value)


def age(name: Column) -> Column:
    return F.regexp_extract(F.lower(name), r"([0-9]{1,2}) ?(?:years?|yrs?|yo)\b", 1).try_cast("int")


def classify(text: Column, classes: tuple[tuple[str, str], ...] = CLASSES) -> Column:
    chain = None
    for name, pattern in classes:
        hit = F.lower(text).rlike(pattern)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("other")


#: Words of hemp and cannabis products.
HEMP_WORDS = (
    "hemp", "cbd", "thc", "thca", r"delta[\s-]?(?:8|9|10)", "d8", "d9", "hhc", "cbn", "cbg", "cbc", "cannabis", "cannabinoid",
    "marijuana", "edible", r"full[\s-]?spectrum",
)
#: How products without alcohol are named; a share of nutrition (0 % sugar) is none.
NON_ALCOHOLIC_WORDS = (
    r"non[\s-]?alcoholic", r"alcohol[\s-]?free", r"de[\s-]?alcoholi[sz]ed", r"zero[\s-]?proof", r"non[\s-]?alc",
    r"N\.?A\.?\s+beer", r"N\.?A\.?\s+(?:i\.?)?p\.?a",
)
NON_ALCOHOLIC_FIGURES = (r"\b0(?:\.\d)?\s*%(?!\s*(?:sugar|carb|fat|sodium|juice|added))", r"\b0\.0\b")
#: Brands and lines without alcohol whose names do not say so.
NON_ALCOHOLIC_BRANDS = (
    "athletic", r"heineken\s*0\.?0?", "budweiser zero", "corona (?:cero|sunbrew)", r"guinness\s*0", "lagunitas ipna",
    "best day brewing", "partake", "ghia", "seedlip", "ritual zero", "lyre'?s", "monday (?:gin|zero)", "gruvi", "surely",
    r"st\.?\s*agrestis", "hop wtr", "for bitter for worse", "three spirit", "sipsmith freeglider",
)
#: Words of domestic and of imported goods.
DOMESTIC_WORDS = (
    r"u\.?s\.?a?", "united states", "america", "domestic", "california", "kentucky", "tennessee", "oregon", "washington",
    "new york", "texas", "napa", "sonoma", "willamette", "bourbon",
)
IMPORT_WORDS = (
    "france", "italy", "spain", "scotland", "ireland", "mexico", "germany", "japan", "canada", "chile", "argentina", "australia",
    "portugal", "import(?:ed)?",
)
#: Containers by the words that tell them, the first counts; else it is a bottle.
CONTAINERS = (("can", r"\bcans?\b|\bsltz\b|seltzer"), ("keg", r"\bkeg\b"), ("box", r"\bbox\b|bag.?in.?box|\bbib\b"), ("pouch", r"\bpouch\b"), ("pet", r"\bpet\b|plastic"))
#: The largest volume in millilitres of each tier; what is larger is of the last.
VOLUME_TIERS = (("single-serve", 355.0), ("standard", 1000.0), ("large", 1499.999999))
LARGEST_TIER = "magnum+"


def _any_word(text: Column, words: tuple[str, ...], *figures: str) -> Column:
    return F.coalesce(text.rlike("(?i)" + "|".join([rf"\b(?:{'|'.join(words)})\b", *figures])), F.lit(False))


def is_hemp(*texts: Column) -> Column:
    return _any_word(F.concat_ws(" ", *texts), HEMP_WORDS)


def is_non_alcoholic(*texts: Column) -> Column:
    """By name, category and brand; a shop's category is the surest sign."""
    joined = F.concat_ws(" ", *texts)
    return _any_word(joined, NON_ALCOHOLIC_WORDS, *NON_ALCOHOLIC_FIGURES) | _any_word(joined, NON_ALCOHOLIC_BRANDS)


def origin_class(*texts: Column) -> Column:
    """domestic or import by what origin and name say; null where they say nothing."""
    joined = F.concat_ws(" ", *texts)
    return F.when(_any_word(joined, DOMESTIC_WORDS), "domestic").when(_any_word(joined, IMPORT_WORDS), "import")


def volume_tier(ml: Column) -> Column:
    tier = F.when(ml.isNull(), None)
    for name, most in VOLUME_TIERS:
        tier = tier.when(ml <= most, name)
    return tier.otherwise(LARGEST_TIER)


def container(name: Column, told: Column | None = None) -> Column:
    """What is told of the container, else what the name says, else a bottle."""
    n, kind = F.lower(F.coalesce(name, F.lit(""))), None
    for what, pattern in CONTAINERS:
        kind = F.when(n.rlike(pattern), what) if kind is None else kind.when(n.rlike(pattern), what)
    said = kind.otherwise("bottle")
    return said if told is None else F.coalesce(F.nullif(F.lower(F.trim(told.cast("string"))), F.lit("")), said)


def unit_price(price: Column, ml: Column, pack: Column | None = None, per: float = 750.0) -> Column:
    """Price of 750 ml; null without a price or a size."""
    volume = ml * (F.lit(1) if pack is None else pack)
    return F.when((price > 0) & (volume > 0), price * per / volume)


def landed_cost(base: Column, gallons: Column, federal: Column, state: Column, sales: Column) -> Column:
    """Cost with excise by the gallon, then sales tax on all of it."""
    return (base + gallons * (federal + state)) * (1 + sales)


def pretax_price(shelf: Column, gallons: Column, federal: Column, state: Column, sales: Column) -> Column:
    return shelf / (1 + sales) - gallons * (federal + state)


def break_even(price: Column, cost: Column, fixed: Column) -> dict[str, Column]:
    margin = price - cost
    return {"margin": margin, "margin_pct": F.try_divide(100 * margin, price), "markup_pct": F.try_divide(100 * margin, cost), "units": F.when(margin > 0, F.ceil(fixed / margin))}


def split_promo(value: Column) -> tuple[Column, Column]:
    """A promotion as a number where it is one, and as text where it is not."""
    number = F.regexp_replace(value, r"[$,\s]", "").try_cast("double")
    return number, F.when(number.isNull() & (F.trim(value) != ""), value)


def placeholder_name(name: Column) -> Column:
    return F.coalesce(F.lower(F.trim(name)).rlike(r"^(n/?a|none|null|test.*|unknown|tbd|\?+|-+|product|item)$"), F.lit(True)) | (F.trim(name) == "")


def mnemonic(name: Column, length: int = 4) -> Column:
    """A short code: the first letters of words, filled up from the first word's consonants."""
    clean = F.upper(F.regexp_replace(name, "[^A-Za-z0-9 ]", ""))
    initials = F.regexp_replace(clean, "([A-Z0-9])[A-Z0-9]* *", "$1")
    consonants = F.regexp_replace(F.substring_index(clean, " ", 1), "^.|[AEIOU]", "")
    return F.rpad(F.substring(F.concat(initials, consonants), 1, length), length, "X")


def uuid_of_token(token: Column) -> Column:
    """A UUID from its 22 characters of URL-safe base64; other values as they are, in lower case."""
    is_token = token.rlike("^[A-Za-z0-9_-]{22}$")
    plain = F.concat(F.translate(F.when(is_token, token), "-_", "+/"), F.lit("=="))
    h = F.lower(F.hex(F.unbase64(plain)))
    dashed = F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(is_token, dashed).otherwise(F.lower(token))


#: Number words that stand for figures in product names.
SPOKEN_NUMBERS = {
    "eight": "8", "ten": "10", "twelve": "12", "fifteen": "15", "eighteen": "18", "twenty": "20", "twentyone": "21",
    "twentyfive": "25", "thirty": "30", "ocho": "8", "diez": "10", "doce": "12",
}
#: Words that say nothing of which product is meant.
FILLER_WORDS = ("the", "a", "an", "of", "and", "by", "brand", "wine", "spirits", "co", "company", "inc", "ltd")
#: Letters that sound alike, each class under its first.
SOUNDS = ("aeiou", "kqc", "szx", "td", "jg", "vb")


def spoken(text: Column) -> Column:
    """A name as it is compared: lower case, letters and figures only, number words as figures, without filler words; an
    unknown name is empty."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^a-z0-9]+", " ")), " ")
    figures = F.create_map(*[F.lit(x) for pair in SPOKEN_NUMBERS.items() for x in pair])
    told = F.transform(words, lambda w: F.coalesce(F.try_element_at(figures, w), w))
    return F.array_join(F.filter(told, lambda w: ~w.isin(*FILLER_WORDS) & (w != "")), " ")


def phonetic(text: Column) -> Column:
    """How a name's words sound: alike letters are one and no letter is doubled, so that `rittenhouse` meets `ridenhouse`
    and `chivas` meets `chibas`. Figures are identity and stay as they are."""
    alike = "".join(c[1:] for c in SOUNDS), "".join(c[0] * (len(c) - 1) for c in SOUNDS)

    def sound(word: Column) -> Column:
        folded = F.translate(F.replace(word, F.lit("ph"), F.lit("f")), *alike)
        return F.when(word.rlike("^[0-9]+$"), word).otherwise(F.regexp_replace(folded, r"(.)\1+", "$1"))

    return F.array_join(F.transform(F.split(spoken(text), " "), sound), " ")


def split_of(key: Column, parts: int = 20) -> Column:
    """A number below parts from the key's md5: the same key is always in the same split."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int")
