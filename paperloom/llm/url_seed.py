"""A small labelled URL table, drawn by rule from words that are commonly met in the hosts and paths of either class.

Blocked hosts are stems of their trade, alone, in pairs or beside the words that advertise them, more often under cheap
endings and redirecting paths; allowed hosts are everyday words, which now and then stand beside the same advertising
words, endings and paths. So a URL is known by its stem where the stem is in the table, and by its form where it is not.
There are three allowed URLs for a blocked one: what the model knows nothing of is allowed.
"""

from __future__ import annotations

import random
import zlib

#: Words of gambling, pills, adult pages, quick loans, pirated software, counterfeits, advertising, traps and bulk mail. Fixed values.
BLOCKED = (
    "casino", "poker", "roulette", "blackjack", "slots", "jackpot", "betting", "sportsbook", "gambling", "bingo", "lotto", "wager", "highroller", "freespins", "bookmaker",
    "viagra", "cialis", "levitra", "pharmacy", "painkillers", "steroids", "slimming", "weightloss", "potency", "tramadol", "xanax", "testosterone",
    "porn", "xxx", "sex", "nude", "escort", "webcams", "hentai", "milf", "erotic", "hookup", "swingers", "fetish", "camgirls", "onlyadults",
    "payday", "loans", "cashadvance", "creditrepair", "debtrelief", "forex", "bitcoindouble", "getrich", "easymoney", "investfast", "binaryoptions",
    "crack", "keygen", "warez", "torrent", "serials", "nulled", "pirate", "activator", "cheats", "aimbot", "fullversion",
    "replica", "knockoff", "outlet", "discountbags", "fakewatches", "clearance", "wholesale", "bargainshoes",
    "adserver", "adclick", "popunder", "banners", "affiliate", "tracker", "trackpixel", "clickbank", "retarget", "impressions", "adnetwork", "toolbar",
    "phish", "verifyaccount", "securelogin", "updatebilling", "confirmidentity", "accountlocked", "walletrecover", "malware", "spyware", "trojan", "codecinstall",
    "spammer", "bulkmail", "linkfarm", "backlinks", "seoboost", "giveaway", "freegift", "prizewinner", "claimnow", "surveyreward", "limitedoffer", "chainletter",
    "pills", "meds", "diet", "bets", "spins", "dating", "singles", "downloads", "ads", "track", "spam", "popups",
)
#: Words of everyday hosts and sections. Fixed values.
ALLOWED = (
    "academy", "airport", "algebra", "almanac", "animals", "archive", "astronomy", "atlas", "bakery", "banking", "baseball", "biology", "books", "botany", "bread", "bridge", "budget", "cathedral",
    "chapter", "chemistry", "children", "choir", "cinema", "citizen", "climate", "coast", "college", "community", "compiler", "concert", "cooking", "council", "courses", "cricket", "culture", "cycling",
    "daily", "dance", "database", "design", "dictionary", "diocese", "district", "docs", "drawing", "economy", "education", "election", "energy", "engineering", "environment", "essays", "events", "factory",
    "family", "farming", "festival", "fiction", "fishing", "flowers", "football", "forest", "forum", "foundation", "gallery", "gardening", "gazette", "geography", "geology", "grammar", "guitar", "harbour",
    "health", "herald", "heritage", "highway", "history", "hiking", "hospital", "housing", "hydrology", "insects", "institute", "islands", "journal", "justice", "kernel", "kitchen", "knitting", "lakes",
    "language", "lawyer", "lecture", "letters", "library", "linguistics", "literature", "magazine", "mathematics", "medicine", "memorial", "meteorology", "ministry", "mountain", "museum", "music", "nature",
    "newspaper", "novel", "nursery", "observer", "ocean", "opera", "orchard", "painting", "parish", "parliament", "periodic", "philosophy", "photo", "physics", "planets", "poetry", "police", "pottery",
    "primary", "profile", "public", "railway", "readers", "recipes", "records", "region", "research", "review", "rivers", "sailing", "school", "science", "sculpture", "senate", "society", "software",
    "station", "statistics", "stories", "student", "surgery", "teacher", "telegraph", "theatre", "tides", "timetable", "tourism", "trains", "travel", "tribune", "university", "vaccine", "valley", "village",
    "vineyard", "volunteer", "weather", "wedding", "wiki", "wildlife", "winter", "woodwork", "writer", "zoology",
)
#: Words that advertise. Fixed values.
PUSHING = ("free", "cheap", "buy", "win", "bonus", "discount", "instant", "adult", "hot", "live", "secret", "cash", "fast", "real", "lucky", "vip", "big", "easy", "sexy", "extra", "super", "mega", "deal", "promo")
#: Words that stand beside those of either class, and endings. Fixed values.
FILLERS = ("online", "world", "zone", "hub", "central", "club", "group", "best", "top", "new", "today", "my", "the", "go", "site", "web", "info", "plus", "pro", "land", "point", "express", "direct", "global", "city", "north")
ENDINGS = ("com", "net", "org", "info", "biz", "io", "co", "eu", "de", "fr", "es", "it", "nl", "pl", "co.uk", "com.au", "ca", "us", "me", "tv", "xyz", "top", "site", "online")
OPENERS = ("", "", "", "www.", "www.", "m.", "blog.", "shop.", "news.", "cdn.", "static.", "app.", "forum.", "img2.", "web01.", "eu-west.")
CHEAP_ENDINGS = ("click", "bid", "win", "loan", "xyz", "top", "site", "online", "club", "icu", "buzz", "biz", "info")
HOSTS = ("{w}", "{w}-{f}", "{f}-{w}", "{w}{f}", "{f}{w}", "{w}{d}", "{w}.{f}{d}", "{f}.{w}", "{w}-{f}-{d}", "{f}{d}.{w}-{f}")
PUSHING_HOSTS = ("{a}-{w}", "{a}{w}", "{w}-{a}", "{a}-{w}-{d}", "{w}-{v}", "{w}{v}", "{a}-{w}-{f}", "{f}.{a}-{w}", "{a}{w}{d}", "the-{a}-{w}")
PATHS = ("", "/", "/index.html", "/index.php", "/{d}", "/p/{d}", "/{f}/{d}.html", "/{y}/{m}/{f}-{f}", "/category/{f}", "/{f}/{f}/", "/wp-content/uploads/{y}/{m}/{f}.jpg", "/item?id={d}", "/search?q={f}", "/#{f}", "/en-gb/{f}", "/~{f}/{d}", "/a/{f}.aspx")
WORD_PATHS = ("/{w}", "/{w}/{d}", "/{f}/{w}.html", "/{w}-{f}/", "/tag/{w}", "/{y}/{f}-{w}-{f}")
PUSHING_PATHS = ("/go/{d}", "/out/{w}", "/click/{d}", "/aff/{d}", "/{a}/{w}", "/join/{a}", "/offer/{d}", "/{a}-{w}/", "/lp{d}/", "/track.php?c={d}")
#: Shares of blocked and of allowed URLs that have a pushing host, path or ending.
PUSH = {1: (0.6, 0.3, 0.4), 0: (0.1, 0.03, 0.08)}


def seed_urls(rows: int = 8_000, seed: int = 1, blocked: tuple[str, ...] = BLOCKED, allowed: tuple[str, ...] = ALLOWED) -> list[tuple[str, int]]:
    """(url, label) with label 1 for blocked, one row in four. Words of its class stand in the host, in the path of a host
    of fillers, or in both."""
    draw = random.Random(seed)
    out = []
    for k in range(rows):
        label = int(k % 4 == 0)
        words = blocked if label else allowed
        word, other = draw.choice(words), draw.choice(words)
        push = [draw.random() < share for share in PUSH[label]]

        def filled(form: str, word: str = word, other: str = other) -> str:
            form = form.replace("{w}", word).replace("{v}", other).replace("{y}", str(draw.randint(2001, 2024))).replace("{m}", f"{draw.randint(1, 12):02d}")
            for mark, choices in (("{f}", FILLERS), ("{a}", PUSHING)):
                while mark in form:
                    form = form.replace(mark, draw.choice(choices), 1)
            while "{d}" in form:
                form = form.replace("{d}", str(draw.randint(1, 10 ** draw.randint(1, 6))), 1)
            return form

        where = draw.random()
        host = filled("{f}{f}" if where < 0.1 else draw.choice(PUSHING_HOSTS if push[0] else HOSTS))
        path = filled(draw.choice(WORD_PATHS if where < 0.2 else PUSHING_PATHS if push[1] else PATHS))
        out.append((f"{draw.choice(('http', 'https', 'https'))}://{draw.choice(OPENERS)}{host}.{draw.choice(CHEAP_ENDINGS if push[2] else ENDINGS)}{path}", label))
    return out


def split_words(words: tuple[str, ...], part: int, parts: int = 5) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(the words of a part, all others), so that a model is set and measured on stems that it was not trained on."""
    of = {w: zlib.crc32(w.encode()) % parts for w in words}
    return tuple(w for w in words if of[w] == part), tuple(w for w in words if of[w] != part)
