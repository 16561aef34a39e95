"""Rules that tell categories and sports by what titles say. Lists hold words and phrases; a hash stands for a digit, a blank at the end for a further word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

# The first category with a match counts, "sports" without any.
CATEGORIES: dict[str, list[str]] = {
    "pokemon": [
        "pokemon", "pokémon", "pikachu", "charizard", "mewtwo", "eevee", "umbreon", "gengar", "lugia", "rayquaza", "blastoise", "venusaur", "vmax", "vstar",
        "gx", "ex card", "paldea", "scarlet & violet", "obsidian flames", "crown zenith", "brilliant stars", "evolving skies", "base set", "jungle",
        "fossil", "neo genesis", "team rocket", "shadowless", "1st edition holo", "illustration rare", "151 ", "prismatic evolutions", "surging sparks",
        "twilight masquerade", "temporal forces", "paradox rift", "lost origin", "silver tempest", "fusion strike", "chilling reign", "celebrations",
        "hidden fates", "shining fates", "champions path", "champion's path", "sword & shield", "sun & moon", "xy ", "black & white", "heartgold",
        "pokémon center", "tcg",
    ],
    "yugioh": ["yugioh", "yu-gi-oh", "yu-gioh", "yugi-oh", "dark magician", "blue-eyes", "exodia", "kaiba", "yugi"],
    "magic": ["mtg", "magic the gathering", "magic: the gathering", "black lotus", "mox ", "planeswalker", "commander deck"],
    "tcg_other": [
        "one piece card", "one piece tcg", "dragon ball super card", "lorcana", "flesh and blood", "weiss schwarz", "digimon card", "metazoo", "cardfight",
        "union arena", "star wars unlimited",
    ],
    "veefriends": ["veefriends", "vee friends", "vfriends", "vee-friends"],
    "coins": [
        "morgan dollar", "peace dollar", "silver eagle", "half dollar", "numismatic", "pcgs ms", "ngc ms", "double eagle", "saint-gaudens", "saintgaudens",
        "walking liberty", "mercury dime", "buffalo nickel", "krugerrand", "maple leaf coin", "american eagle coin", "quarter eagle", "half eagle",
        "liberty head", "bullion", "troy oz", "proof set", "mint set", "ms-6#", "ms6#", "ms-70", "ms70",
    ],
    "watches": [
        "rolex", "patek philippe", "audemars piguet", "omega seamaster", "omega speedmaster", "cartier", "panerai", "grand seiko", "tudor", "iwc",
        "tag heuer", "breitling", "jaeger-lecoultre", "jaegerlecoultre", "hublot", "chopard", "richard mille", "vacheron", "a. lange", "wristwatch", "chronograph",
    ],
    "comics": ["cgc #.#", "cbcs", "comic", "marvel comics", "dc comics", "first appearance", "1st appearance"],
    "funko": ["funko", "pop! vinyl", "funko pop"],
    "video_games": ["wata", "vga graded", "nintendo", "playstation", "xbox", "sega genesis", "game boy", "nes ", "snes ", "n64"],
}
#: Patterns of a category beyond words.
MORE_PATTERNS = {"coins": ["[0-9]+ coin", "coins?([^a-z0-9_].*)?[^a-z0-9_](lot|roll|proof|uncirculated)"], "comics": ["(x-men|spider-man|batman) [#][a-z0-9_]"]}
# The first sport with a match counts; leagues go before teams.
LEAGUES: dict[str, list[str]] = {
    "basketball": [
        "nba", "basketball", "hoops", "court kings", "prizm basketball", "select basketball", "donruss basketball", "optic basketball", "mosaic basketball",
        "fleer basketball", "skybox", "topps basketball", "slam dunk", "all-nba", "nba finals", "mcdonalds all american", "mcdonald's all american",
    ],
    "football": [
        "nfl", "football", "gridiron", "contenders football", "prizm football", "select football", "donruss football", "optic football", "mosaic football",
        "score football", "playoff contenders", "nfl draft", "super bowl", "heisman", "college football", "ncaa football",
    ],
    "baseball": [
        "mlb", "baseball", "bowman", "topps chrome baseball", "topps series", "topps update", "stadium club", "heritage baseball", "topps now",
        "topps finest", "topps archives", "allen & ginter", "gypsy queen", "donruss baseball", "prizm baseball", "home run", "world series",
        "all-star game", "cy young", "rookie card rc baseball", "minor league",
    ],
    "hockey": [
        "nhl", "hockey", "young guns", "upper deck hockey", "o-pee-chee", "opc ", "sp authentic hockey", "the cup hockey", "ice hockey", "stanley cup",
        "ahl", "chl", "ohl", "whl", "khl",
    ],
    "soccer": [
        "soccer", "futbol", "fútbol", "football club", "premier league", "uefa", "champions league", "bundesliga", "la liga", "serie a", "ligue 1", "mls",
        "world cup", "euro 20##", "copa america", "topps chrome uefa", "panini select fifa", "fifa", "merlin", "obsidian soccer", "prizm premier league",
        "donruss soccer", "select la liga", "real madrid", "barcelona", "manchester united", "man utd", "liverpool fc", "arsenal", "chelsea fc",
        "bayern", "psg", "juventus", "inter miami",
    ],
    "wnba": ["wnba", "caitlin clark", "angel reese", "paige bueckers", "aja wilson", "a'ja wilson", "sabrina ionescu", "breanna stewart"],
    "ufc_mma": ["ufc", "mma", "bellator", "conor mcgregor", "jon jones", "khabib", "israel adesanya", "alex pereira", "ilia topuria"],
    "wrestling": [
        "wwe", "aew", "wrestling", "wrestler", "hulk hogan", "stone cold", "undertaker", "john cena", "roman reigns", "cody rhodes", "rey mysterio", "ric flair",
    ],
    "racing": [
        "f1", "formula 1", "formula one", "nascar", "indycar", "verstappen", "hamilton f1", "lando norris", "leclerc", "topps chrome f1", "turbo attax",
        "dale earnhardt", "kyle larson", "chase elliott",
    ],
    "golf": ["golf", "pga", "masters", "tiger woods", "scottie scheffler", "rory mcilroy", "sgc 10 golf", "upper deck golf"],
    "tennis": [
        "tennis", "wimbledon", "us open tennis", "roland garros", "alcaraz", "jannik sinner", "serena williams", "federer", "nadal", "djokovic", "coco gauff",
    ],
    "boxing": ["boxing", "muhammad ali", "mike tyson", "canelo", "floyd mayweather", "tyson fury", "jake paul"],
}
TEAMS: dict[str, list[str]] = {
    "basketball": [
        "lakers", "celtics", "warriors", "bulls", "knicks", "nets", "heat", "spurs", "mavericks", "nuggets", "bucks", "76ers", "sixers", "suns", "rockets",
        "thunder", "grizzlies", "pelicans", "timberwolves", "trail blazers", "blazers", "jazz", "clippers", "hawks", "hornets", "cavaliers", "cavs",
        "pistons", "pacers", "raptors", "wizards",
    ],
    "football": [
        "chiefs", "eagles", "cowboys", "49ers", "niners", "packers", "steelers", "patriots", "bills", "dolphins", "ravens", "bengals", "browns", "texans",
        "colts", "jaguars", "titans", "broncos", "raiders", "chargers", "seahawks", "rams", "falcons", "saints", "buccaneers", "bucs", "bears", "lions",
        "vikings", "commanders", "redskins",
    ],
    "baseball": [
        "yankees", "dodgers", "red sox", "cubs", "mets", "braves", "astros", "phillies", "padres", "orioles", "blue jays", "mariners", "guardians",
        "indians", "twins", "tigers", "royals", "white sox", "brewers", "reds", "pirates", "rockies", "diamondbacks", "marlins", "nationals",
        "athletics", "angels",
    ],
    "hockey": [
        "maple leafs", "canadiens", "bruins", "blackhawks", "red wings", "penguins", "capitals", "oilers", "flames", "canucks", "avalanche",
        "golden knights", "lightning", "hurricanes", "devils", "islanders", "flyers", "sabres", "senators", "predators", "wild", "ducks", "sharks",
        "kraken", "blue jackets", "coyotes", "mammoth",
    ],
}
#: makers' lines that lean to a sport where nothing else says one.
LEANINGS: dict[str, list[str]] = {
    "baseball": ["bowman", "topps chrome", "topps update", "topps series", "heritage", "stadium club", "topps now", "topps finest"],
    "hockey": ["upper deck", "sp authentic", "artifacts", "synergy", "black diamond", "ice "],
    "basketball": ["court kings", "hoops", "crown royale", "revolution", "noir basketball"],
    "football": ["playbook", "contenders", "absolute football", "certified football", "limited football", "gold standard"],
}
# Keywords of the first audit, found anywhere in a text.
KEYWORD_CATEGORIES: dict[str, list[str]] = {
    "pokemon": ["pokemon", "pikachu", "charizard", "mewtwo", "pokémon", "eevee", "vmax", "vstar", "paldea", "scarlet & violet", "obsidian flames", "crown zenith", "brilliant stars"],
    "yugioh": ["yu-gi-oh", "yugioh", "yu gi oh", "dark magician", "blue-eyes white dragon", "exodia"],
    "veefriends": ["veefriends", "vee friends", "gary vee", "garyvee", "zerocool", "vfriends", "vee friends series"],
    "watches": [
        "rolex", "patek philippe", "audemars piguet", "omega seamaster", "omega speedmaster", "cartier", "panerai", "grand seiko", "tudor", "iwc",
        "tag heuer", "breitling", "jaeger-lecoultre", "jaeger lecoultre", "hublot", "chopard", "richard mille", "vacheron constantin", "a. lange",
        "a lange", " watch ", "wristwatch", "chronograph",
    ],
    "coins": [
        "coin", "coins", "morgan dollar", "peace dollar", "silver eagle", "half dollar", "numismatic", "pcgs ", "ngc ", "double eagle", "saint-gaudens",
        "saint gaudens", "walking liberty", "mercury dime", "buffalo nickel", "krugerrand", "maple leaf", "american eagle", "quarter eagle", "half eagle",
        "liberty head",
    ],
}
KEYWORD_SPORTS: dict[str, list[str]] = {
    "basketball": ["basketball", " nba", "hoops", "wembanyama", "lebron", "jordan", "kobe", "curry", "luka", "giannis", "jokic", "tatum", "prizm basketball", "court kings"],
    "football": ["football", " nfl", "mahomes", "brady", "burrow", "stroud", "jayden daniels", "caleb williams", "gridiron", "contenders football", "prizm football"],
    "baseball": ["baseball", " mlb", "topps chrome", "bowman", "ohtani", "judge", "skenes", "elly de la cruz", "topps now", "heritage", "stadium club", "topps update"],
    "hockey": ["hockey", " nhl", "upper deck", "young guns", "bedard", "mcdavid", "crosby", "ovechkin", "gretzky", "o-pee-chee", "opc "],
    "soccer": [
        "soccer", "futbol", "football club", "premier league", "uefa", "messi", "ronaldo", "mbappe", "mbappé", "haaland", "bellingham", "yamal",
        "topps chrome uefa", "panini select fifa", "fifa",
    ],
    "wnba": ["wnba", "caitlin clark", "angel reese", "paige bueckers"],
    "ufc_mma": [" ufc", " mma", "conor mcgregor", "jon jones", "khabib"],
    "wrestling": [" wwe", " aew", "wrestling", "hulk hogan", "the rock dwayne"],
    "racing": ["f1 ", "formula 1", "formula one", "nascar", "verstappen", "hamilton lewis", "topps chrome f1", "turbo attax"],
    "golf": [" golf", " pga", "tiger woods", "scheffler"],
    "tennis": ["tennis", "wimbledon", "alcaraz", "sinner ", "serena", "federer", "nadal", "djokovic"],
    "boxing": ["boxing", "tyson", "ali muhammad", "canelo"],
}


def _pattern(terms: Sequence[str], more: Sequence[str] = ()) -> str:
    """A pattern for any of the terms as whole words, the same in RE2 and Java."""

    def one(term: str) -> str:
        text = "".join("[0-9]" if c == "#" else "[.]" if c == "." else c for c in term)
        return text + "[A-Za-z0-9_]" if text.endswith(" ") else text + "([^A-Za-z0-9_]|$)"

    return "(^|[^A-Za-z0-9_])(" + "|".join([*map(one, terms), *[m + "([^A-Za-z0-9_]|$)" for m in more]]) + ")"


CATEGORY_RULES = [(name, _pattern(terms, MORE_PATTERNS.get(name, ()))) for name, terms in CATEGORIES.items()]
SPORT_RULES = [(name, _pattern(terms)) for lists in (LEAGUES, TEAMS) for name, terms in lists.items()]
LEANING_RULES = [(name, _pattern(terms)) for name, terms in LEANINGS.items()]


def keyword(text: Column, lists: dict[str, list[str]], default: str) -> Column:
    """The first list one of whose keywords occurs anywhere in the text."""
    hit = lambda terms: F.exists(F.array(*map(F.lit, terms)), lambda k: text.contains(k))
    return rules.first_of([(hit(terms), name) for name, terms in lists.items()], default)


def category_by_keyword(title: Column, query: Column) -> Column:
    """The first audit's category of a title and the query that found it."""
    both = F.concat(F.lower(F.coalesce(title, F.lit(""))), F.lit(" "), F.lower(F.coalesce(query, F.lit(""))), F.lit(" "))
    return keyword(both, KEYWORD_CATEGORIES, "sports")


def sport_by_keyword(title: Column, query: Column) -> Column:
    both = F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))), F.lit(" "), F.lower(F.coalesce(query, F.lit(""))), F.lit(" "))
    return keyword(both, KEYWORD_SPORTS, "unknown")
