"""Lookup data for the text steps: chat abbreviations, emoticons, emoji names, lemmas, stopwords.

The built-in tables are small seeds. ``Lexicon.from_table`` builds one from any ``(lang, key, value)``
table, so a team can keep its word lists in a table of its own.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many entries a lexicon no longer goes into the plan as a literal; see operators.tokenmap.
MAX_LITERAL_ENTRIES = 20_000

# Seed rows ``(lang, key, value)``: abbreviations of chat messages. Teams bring their own with `Lexicon.from_table`.
CHAT_WORDS = (
    ("en", "asap", "as soon as possible"),
    ("en", "b4", "before"),
    ("en", "brb", "be right back"),
    ("en", "btw", "by the way"),
    ("en", "fyi", "for your information"),
    ("en", "idk", "i do not know"),
    ("en", "lol", "laughing out loud"),
    ("en", "msg", "message"),
    ("en", "np", "no problem"),
    ("en", "pls", "please"),
    ("en", "thx", "thanks"),
    ("en", "u", "you"),
    ("en", "ur", "your"),
    ("es", "msj", "mensaje"),
    ("es", "salu2", "saludos"),
    ("es", "tqm", "te quiero mucho"),
    ("es", "xfa", "por favor"),
    ("es", "xq", "porque"),
    ("fr", "bcp", "beaucoup"),
    ("fr", "dsl", "désolé"),
    ("fr", "mdr", "mort de rire"),
    ("fr", "rdv", "rendez-vous"),
    ("fr", "stp", "s'il te plaît"),
    ("de", "kp", "kein problem"),
    ("de", "lg", "liebe grüße"),
    ("de", "thx", "danke"),
    ("de", "vlt", "vielleicht"),
    ("pt", "hj", "hoje"),
    ("pt", "obg", "obrigado"),
    ("pt", "tb", "também"),
    ("pt", "vc", "você"),
    ("it", "cmq", "comunque"),
    ("it", "grz", "grazie"),
    ("it", "nn", "non"),
    ("it", "tvb", "ti voglio bene"),
)

# Seed rows: emoticons. Where a language has no row for one, it becomes a neutral tag of the English meaning.
EMOTICONS = (
    ("en", ":)", "smile"),
    ("en", ":-)", "smile"),
    ("en", ":D", "big grin"),
    ("en", ":-D", "big grin"),
    ("en", "XD", "loud laugh"),
    ("en", ";)", "wink"),
    ("en", ";-)", "wink"),
    ("en", ":(", "sadness"),
    ("en", ":-(", "sadness"),
    ("en", ":'(", "crying"),
    ("en", ":P", "tongue out"),
    ("en", ":-P", "tongue out"),
    ("en", ":O", "surprise"),
    ("en", ":-O", "surprise"),
    ("en", ":-/", "doubt"),
    ("en", ":-|", "blank look"),
    ("en", "<3", "love"),
    ("en", "^_^", "joy"),
    ("en", "-_-", "annoyance"),
    ("es", ":)", "sonrisa"),
    ("es", ":-)", "sonrisa"),
    ("es", ":D", "gran sonrisa"),
    ("es", ":(", "tristeza"),
    ("es", ":-(", "tristeza"),
    ("es", "<3", "amor"),
)

# English words that end in s and are no plurals, and words whose plural keeps the e or is irregular.
NOT_PLURAL = tuple(
    "afterwards alias always atlas besides bias canvas christmas cookies does goes hoodies kansas lens mathematics movies news"
    " nowadays overseas perhaps physics politics selfies series sideways sometimes species texas themselves thermos towards whereas"
    " yourselves ourselves zombies".split()
)

# Irregular forms; regular English plurals are handled by rule.
LEMMAS = {
    "en": """
        am = be
        are = be
        been = be
        best = good
        better = good
        bought = buy
        children = child
        did = do
        done = do
        feet = foot
        got = get
        had = have
        has = have
        is = be
        made = make
        men = man
        mice = mouse
        paid = pay
        people = person
        said = say
        sent = send
        teeth = tooth
        told = tell
        was = be
        went = go
        were = be
        women = woman
        worse = bad
        worst = bad
    """,
    "es": """
        compras = compra
        cuentas = cuenta
        días = día
        errores = error
        facturas = factura
        pagos = pago
        pedidos = pedido
        problemas = problema
        productos = producto
        servicios = servicio
        veces = vez
        vuelos = vuelo
    """,
    "fr": """
        animaux = animal
        colis = colis
        commandes = commande
        comptes = compte
        factures = facture
        journaux = journal
        problèmes = problème
        produits = produit
        services = service
        yeux = oeil
    """,
    "de": """
        bestellungen = bestellung
        fehler = fehler
        konten = konto
        kunden = kunde
        probleme = problem
        produkte = produkt
        rechnungen = rechnung
        züge = zug
    """,
    "pt": """
        compras = compra
        contas = conta
        pedidos = pedido
        problemas = problema
        produtos = produto
        serviços = serviço
    """,
    "it": """
        clienti = cliente
        conti = conto
        ordini = ordine
        problemi = problema
        prodotti = prodotto
        servizi = servizio
    """,
}

# Names under which Spark ships its stopword lists.
STOPWORD_LISTS = {
    "en": "english",
    "es": "spanish",
    "fr": "french",
    "de": "german",
    "pt": "portuguese",
    "it": "italian",
    "nl": "dutch",
    "ru": "russian",
}

# Unicode blocks that hold pictographs; names come from the Unicode character database.
EMOJI_BLOCKS = (
    *((c, c) for c in (0x25B6, 0x25C0, 0x2B50, 0x2B55, 0x1F004, 0x1F0CF, 0x1F18E, 0x1F21A, 0x1F22F)),
    *((0x2194, 0x2199), (0x21A9, 0x21AA), (0x231A, 0x231B), (0x23E9, 0x23F3), (0x23F8, 0x23FA), (0x25AA, 0x25AB), (0x25FB, 0x25FE)),
    *((0x2600, 0x27BF), (0x2934, 0x2935), (0x2B05, 0x2B07), (0x2B1B, 0x2B1C)),
    *((0x1F170, 0x1F171), (0x1F17E, 0x1F17F), (0x1F191, 0x1F19A), (0x1F201, 0x1F202), (0x1F232, 0x1F23A), (0x1F250, 0x1F251)),
    (0x1F300, 0x1FAFF),
)
PICTOGRAPH = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in EMOJI_BLOCKS) + "]"
SKIN, SELECTOR, JOINER, FLAG = r"[\x{1F3FB}-\x{1F3FF}]", r"\x{FE0F}", r"\x{200D}", r"[\x{1F1E6}-\x{1F1FF}]"
# One match per emoji as it is seen: a flag of two letters, a keycap, or pictographs joined to one, with tones and selectors.
EMOJI_PATTERN = (
    rf"{FLAG}{{2}}|[0-9#*]{SELECTOR}?\x{{20E3}}"
    rf"|{PICTOGRAPH}(?:{SELECTOR}|{SKIN})*[\x{{E0020}}-\x{{E007F}}]*(?:{JOINER}{PICTOGRAPH}(?:{SELECTOR}|{SKIN})*)*"
)


KEYCAPS = {**{d: d for d in "0123456789"}, "#": "hash", "*": "star"}


def neutral_tag(name: str, prefix: str) -> str:
    """``Grinning Face`` -> ``emoji_grinning_face``: lower case, ASCII letters, digits and ``_`` only."""
    joined = re.sub(r"[ -]", "_", name.strip(":")).lower()
    return f"{prefix}_" + re.sub(r"[^a-z0-9_]", "", joined)


def parse(block: str) -> dict[str, str]:
    pairs = (line.split(" = ", 1) for line in block.strip().splitlines())
    return {k.strip(): v.strip() for k, v in pairs}


@dataclass(frozen=True)
class Lexicon:
    """Values by language and key. Keys are case-folded; on a collision the exact lower-case key wins."""

    entries: dict[str, dict[str, str]]

    def __post_init__(self):
        folded = {}
        for lang, table in self.entries.items():
            out = {k.lower(): v for k, v in table.items()}
            out.update({k: v for k, v in table.items() if k == k.lower()})
            folded[lang] = out
        object.__setattr__(self, "entries", folded)

    def __len__(self) -> int:
        return sum(len(t) for t in self.entries.values())

    @classmethod
    def from_table(cls, table: DataFrame, max_entries: int = MAX_LITERAL_ENTRIES) -> Lexicon:
        """Read ``(lang, key, value)`` whole; refuses a table above ``max_entries`` (use a token map)."""
        # The limit only guards the driver: one row too many raises, nothing is cut off.
        rows = table.select("lang", "key", "value").limit(max_entries + 1).collect()
        if len(rows) > max_entries:
            raise ValueError(f"lexicon table has more than {max_entries} rows; join it as a token map")
        return from_rows(rows)

    def rows(self) -> list[tuple[str, str, str]]:
        return [(g, k, v) for g, t in sorted(self.entries.items()) for k, v in sorted(t.items())]


def from_rows(rows) -> Lexicon:
    entries: dict[str, dict[str, str]] = {}
    for lang, key, value in rows:
        entries.setdefault(lang, {})[key] = value
    return Lexicon(entries)


@cache
def chat_words() -> Lexicon:
    return from_rows(CHAT_WORDS)


@cache
def lemmas() -> Lexicon:
    return Lexicon({lang: parse(block) for lang, block in LEMMAS.items()})


@cache
def emoticons(languages: tuple[str, ...]) -> Lexicon:
    """Every emoticon in every language: a phrase where there is one, else a neutral tag."""
    tags = {key: neutral_tag(value, "emoticon") for lang, key, value in EMOTICONS if lang == "en"}
    own = from_rows(EMOTICONS).entries
    return Lexicon({lang: {k: own.get(lang, {}).get(k.lower(), tag) for k, tag in tags.items()} for lang in languages})


def alternation(keys) -> str:
    """One pattern for all keys, longest first. Keys that start or end with a letter or digit must not
    touch another one, so that ``xd`` inside a word is left alone."""

    def one(key: str) -> str:
        body = re.sub(r"([^\w\s])", r"\\\1", key, flags=re.ASCII) if key.isascii() else re.escape(key)
        left = r"\b" if key[0].isascii() and key[0].isalnum() else ""
        right = r"\b" if key[-1].isascii() and key[-1].isalnum() else ""
        return left + body + right

    return "|".join(one(k) for k in sorted(keys, key=lambda k: (-len(k), k)))


def guarded_alternation(keys) -> str:
    """`alternation` with a look ahead at the first character, which is about five times as fast in Java
    on text without a match."""

    def first(ks) -> str:
        return "[" + "".join(sorted({re.sub(r"([^\w])", r"\\\1", k[0], flags=re.ASCII) for k in ks})) + "]"

    wordy = [k for k in keys if k[0].isascii() and k[0].isalnum()]
    other = [k for k in keys if k not in set(wordy)]
    parts = []
    if other:
        parts.append(f"(?={first(other)})(?:{alternation(other)})")
    if wordy:
        parts.append(rf"\b(?={first(wordy)})(?:{alternation(wordy)})")
    return "|".join(parts)


def is_emoji(key: str) -> bool:
    return key.endswith("\u20e3") or any(first <= ord(key[0]) <= last for first, last in EMOJI_BLOCKS)


@cache
def emoji_tags() -> tuple[tuple[int, tuple[str, ...]], ...]:
    """Per Unicode block: first code point and the neutral tag of each code point in the block."""
    return tuple(
        (
            first,
            tuple(
                neutral_tag(unicodedata.name(chr(cp), f"u{cp:x}"), "emoji") for cp in range(first, last + 1)
            ),
        )
        for first, last in EMOJI_BLOCKS
    )


@cache
def stopwords(lang: str) -> tuple[str, ...]:
    """Spark's own list for the language; needs a running session."""
    if lang not in STOPWORD_LISTS:
        return ()
    return tuple(StopWordsRemover.loadDefaultStopWords(STOPWORD_LISTS[lang]))


def literal_map(table: dict[str, str]):
    """A map in the plan as one constant, whatever its size. Keys and values must not hold the separators."""
    bad = [k for k, v in table.items() if "\x01" in k + v or "\x02" in k + v]
    if bad:
        raise ValueError(f"control characters in the lexicon entries {bad[:3]}")
    joined = "\x01".join(f"{k}\x02{v}" for k, v in sorted(table.items()))
    return F.str_to_map(F.lit(joined), F.lit("\x01"), F.lit("\x02"))


def literal_list(values):
    return F.split(F.lit("\x01".join(values)), "\x01")
