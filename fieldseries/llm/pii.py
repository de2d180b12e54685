"""Surrogates for personal data, in DataFrame functions only.

Entities are found by one pattern, and every distinct value gets a keyed surrogate of its type and format: digits become
digits, letters become letters of the same script and case, separators stay, addresses stay valid, card and bank numbers keep
whether their check digits hold. A person's name is taken apart: the title or label stays, the family name and every given name have
surrogates of their own in their script, case and (given names) gender, so that Mr Berg, Herr Berg and Mrs Anna Berg keep one family name between
them. Equal values get equal surrogates everywhere (coreference). Distinct values must get distinct surrogates that are no value of
the corpus: those that clash, and only those, take further attempts until none does; they are few and are joined back, all others are computed in place.

A name is found behind a title or a label (Name: ...), or if it begins with one of GIVEN_NAMES; other names stand in no rule and stay.

Defined results: a null text stays null and an empty one empty, both without entities; texts without entities are unchanged;
repeated rows give equal rows; an empty table gives an empty table; texts of any length are read as a whole; all input columns are kept under
their names, and the count of entities takes the first free name of n_entities, _n_entities, ... Names that begin with __pii are the library's.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseries.llm.common import cut, drop_cuts, free_name

# Titles by gender, in the languages' own spelling.
MALE = "Mr Herr Monsieur Señor Sr Sir Mister Signor господин".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Señora Sra Madam Signora госпожа".split()
EITHER = "Dr Prof Doctor Professor".split()
TITLES = [t for given in (*MALE, *FEMALE, *EITHER) for t in (given, given.upper())]
# Labels in front of a name.
LABELS = "Name name NAME Fullname Nom Nombre Имя ФИО".split()
# Given names that begin a name without a title; those of women.
WOMEN = "Anna Maria Mary Elizabeth Jennifer Linda Susan Sarah Karen Nancy Lisa Emily Laura Julia Sophie Marie Claire Camille Isabelle Nathalie Sabine Petra Ursula Monika Heike Carmen Lucia Elena Ana Isabel Pilar Olga Irina Natalia Ольга Ирина Анна Мария Елена Наталья".split()
MEN = "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Andrew Peter Paul Pierre Jean Jacques Michel Philippe Hans Klaus Jürgen Wolfgang Stefan Juan Carlos Antonio Manuel Javier Luis Pedro Ivan Sergei Dmitri Иван Сергей Дмитрий Александр Алексей".split()
GIVEN_NAMES = WOMEN + MEN
# Syllables of names by script, and endings of given names by gender.
SYLLABLES = {"latin": "ba be bo da de do ga ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va vo".split(), "cyrillic": "ба бе бо да де до га ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва во".split()}
ENDINGS = {("latin", "f"): "nia", ("latin", "m"): "rdo", ("cyrillic", "f"): "ния", ("cyrillic", "m"): "рдо"}
# What an entity looks like, in the order in which alternatives are tried.
NAME = r"[\p{Lu}\p{Lo}][\p{L}\p{M}'’-]+"
SECRET = r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:sk|pk|ghp|AKIA)[-_]?[A-Za-z0-9]{16,64})(?![\p{L}\p{N}])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IBAN = r"(?=[A-Z])(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:(?: \d{4}){3,7}(?: \d{1,3})?|[A-Z0-9]{11,30})(?![\p{L}\p{N}])"
IP = r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\p{N}|\.\p{N})"
CARD = r"(?<![\p{N}-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?!\p{N})"
SSN = r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"
PHONE = r"(?<![\p{N}+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,3}|\+\d{8,15}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\p{N})"
PREFIX = rf"(?:(?:{'|'.join(TITLES)})\.?|(?:{'|'.join(LABELS)}):) "
BEGIN = r"(?=[A-ZА-Ягn])(?<!\p{L})"  # how titles, labels and given names begin: tried before the long lists
PERSON = rf"{BEGIN}(?:(?:{PREFIX}){NAME}(?: {NAME}){{0,3}}|(?:{'|'.join(GIVEN_NAMES)}) {NAME}(?: {NAME})?)"
TYPES = {"secret": SECRET, "email": EMAIL, "iban": IBAN, "ip": IP, "card": CARD, "ssn": SSN, "phone": PHONE, "person": PERSON}
PATTERN = "|".join(TYPES.values())
#: Texts that this does not find hold no entity; it is much cheaper than PATTERN.
HINT = rf"[@\d]|{BEGIN}(?:{PREFIX}|(?:{'|'.join(GIVEN_NAMES)}) )[\p{{Lu}}\p{{Lo}}]|[0-9a-fA-F]{{32}}|AKIA|(?:sk|pk|ghp)[-_]?[A-Za-z0-9]{{16}}"
#: After so many attempts a value that still clashes gets a suffix of its own: its type has hardly a free value left.
ATTEMPTS = 50
#: Stands between the parts of a text whose entities are marked.
MARK = "\ue000"


def quoted(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The surrogate is one SQL expression, put together from texts: far smaller to build and plan than columns made one by one.


def let(name: str, value: str, body: str) -> str:
    """body with value computed once under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def kind(value: str) -> str:
    """The type of a found value."""
    cases = " ".join(f"when {value} rlike {quoted(f'^(?:{pattern})$')} then '{name}'" for name, pattern in TYPES.items() if name != "person")
    return f"(case {cases} else 'person' end)"


def normal(type: str, value: str) -> str:
    """Spellings that mean one thing: case of addresses and names, separators of numbers do not count."""
    return f"(case when {type} in ('phone', 'card', 'ssn', 'iban') then upper(regexp_replace({value}, '[ ().-]', '')) when {type} = 'secret' then {value} else lower({value}) end)"


def atoms(value: str, type: str) -> str:
    """What of a value has a surrogate of its own: a person's names, else the value."""
    words = f"split(regexp_replace({value}, {quoted(f'^{PREFIX}')}, ''), ' ')"
    return f"if({type} = 'person', {let('ws', words, "transform(ws, (w, i) -> struct(if(i = size(ws) - 1, 'family', 'given') as t, w as v))")}, array(struct({type} as t, {value} as v)))"


def draw(seed: str, i: str | int, n: str | int) -> str:
    return f"cast(pmod(xxhash64({seed}, {i}), {n}) as int)"


def pick(options: list[str], seed: str, i: str | int) -> str:
    return f"get(split({quoted(' '.join(options))}, ' '), {draw(seed, i, len(options))})"


def chars(value: str) -> str:
    return f"filter(split({value}, ''), c -> c != '')"


#: First and last letter of the alphabets whose letters are drawn from themselves; other letters become Latin ones.
ALPHABETS = ["09", "az", "AZ", "àö", "øÿ", "ÀÖ", "ØÞ", "ая", "АЯ", "αω", "ΑΡ", "άί", "ϊώ", "את", "غي", "कह", "ぁん", "ァン", "一鿿", "가힣"]
SPANS = "array(" + ", ".join(f"struct({ord(a)} as low, {ord(b)} as high)" for a, b in ALPHABETS) + ")"


def letters(value: str, seed: str) -> str:
    """Every digit and letter drawn anew within its script and case; all else stays."""
    drawn = f"decode(unhex(lpad(hex(s.low + {draw(seed, 'i', 's.high - s.low + 1')}), 8, '0')), 'utf-32')"
    own = f"get(transform(filter({SPANS}, s -> ascii(c) between s.low and s.high), s -> {drawn}), 0)"
    other = f"case when c rlike {quoted(r'\p{Lu}')} then char(65 + {draw(seed, 'i', 26)}) when c rlike {quoted(r'\p{L}')} then char(97 + {draw(seed, 'i', 26)}) else c end"
    return f"array_join(transform({chars(value)}, (c, i) -> coalesce({own}, {other})), '')"


def hexadecimal(value: str, seed: str) -> str:
    """Hexadecimal digits anew, in capitals if the value has capitals."""
    drawn = f"array_join(transform({chars(value)}, (c, i) -> substr('0123456789abcdef', 1 + {draw(seed, 'i', 16)}, 1)), '')"
    return f"if({value} rlike '[A-F]', upper({drawn}), {drawn})"


def digits(value: str, seed: str) -> str:
    """Digits anew by their rank among the digits, so that spacing does not change them."""
    step = f"if(c between '0' and '9', struct(acc.n + 1 as n, concat(acc.made, {draw(seed, 'acc.n', 10)}) as made), struct(acc.n as n, concat(acc.made, c) as made))"
    return f"aggregate({chars(value)}, struct(0 as n, '' as made), (acc, c) -> {step}, acc -> acc.made)"


def check_sum(number: str) -> str:
    """The Luhn sum of a string of digits, modulo 10."""
    one = "if(i % 2 = 0, int(c), if(int(c) > 4, int(c) * 2 - 9, int(c) * 2))"
    return f"(aggregate(transform(reverse({chars(number)}), (c, i) -> {one}), 0, (acc, x) -> acc + x) % 10)"


def card(value: str, seed: str) -> str:
    """Digits anew; the last one makes the check sum hold exactly if it held."""
    only = lambda v: f"regexp_replace({v}, '[^0-9]', '')"
    right = f"(10 - {check_sum(f"concat({only('rest')}, '0')")}) % 10"
    last = f"if({check_sum(only(value))} = 0, {right}, ({right} + 1 + {draw(seed, 99, 9)}) % 10)"
    return let("drawn", digits(value, seed), let("rest", "substr(drawn, 1, length(drawn) - 1)", f"concat(rest, {last})"))


def email(value: str, seed: str, domain_seed: str) -> str:
    """Local part and host labels anew, the last label kept; one domain always becomes one other domain."""
    domain = f"substr({value}, instr({value}, '@') + 1)"
    host = f"regexp_replace({domain}, {quoted(r'\.[^.]*$')}, '')"
    return f"concat(lower({letters(f"substr({value}, 1, instr({value}, '@') - 1)", seed)}), '@', lower({letters(host, domain_seed)}), '.', substring_index({domain}, '.', -1))"


def ip(seed: str) -> str:
    return f"concat_ws('.', transform(sequence(0, 3), i -> cast(1 + {draw(seed, 'i', 254)} as string)))"


def iban(value: str, seed: str) -> str:
    """Country and spaces stay, the rest anew, with check digits that hold."""
    number = lambda c: f"if({c} between '0' and '9', int({c}), ascii({c}) - 55)"
    left = f"aggregate({chars("concat(regexp_replace(substr(fresh, 5), ' ', ''), substr(fresh, 1, 2), '00')")}, 0, (acc, c) -> pmod(acc * if(c between '0' and '9', 10, 100) + {number('c')}, 97))"
    return let("fresh", f"concat(substr({value}, 1, 4), {letters(f'substr({value}, 5)', seed)})", f"concat(substr(fresh, 1, 2), lpad(cast(98 - {left} as string), 2, '0'), substr(fresh, 5))")


def name(value: str, type: str, seed: str, attempt: str) -> str:
    """A family or a given name in the script and case of the value; a given name with an ending of its gender. Further attempts make longer ones."""
    women = f"(lower({value}) in ({', '.join(quoted(n.lower()) for n in WOMEN)}) or (lower({value}) rlike '[aeаяά]$' and lower({value}) not in ({', '.join(quoted(n.lower()) for n in MEN)})))"

    def of(script: str) -> str:
        stem = f"array_join(transform(sequence(1, if({type} = 'given', 2, 4) + int(floor({attempt} / 4))), i -> {pick(SYLLABLES[script], seed, 'i')}), '')"
        return f"initcap(concat({stem}, if({type} = 'given', if({women}, '{ENDINGS[script, 'f']}', '{ENDINGS[script, 'm']}'), '')))"

    made = f"case when {value} rlike {quoted(r'^[\p{IsCyrillic}’\x27-]+$')} then {of('cyrillic')} when {value} rlike {quoted(r'^[\p{IsLatin}\p{M}’\x27-]+$')} then {of('latin')} else {letters(value, seed)} end"
    return let("made", made, f"if({value} = upper({value}) and {value} != lower({value}), upper(made), made)")


def mac(key: str, message: str) -> str:
    """A keyed hash, taken twice so that it cannot be carried on by who sees it."""
    inner, outer = (quoted(hashlib.sha256(f"{side}:{key}".encode()).hexdigest()) for side in ("inner", "outer"))
    return f"sha2(concat({outer}, sha2(concat({inner}, {message}), 256)), 256)"


def surrogate(value: str, type: str, norm: str, attempt: str, key: str) -> str:
    """The replacement of an atom: a function of the key, the type, the normal form and the attempt."""
    domain_seed = mac(key, f"concat('domain|', substring_index({norm}, '@', -1))")
    cases = {"email": email(value, "seed", domain_seed), "iban": iban(value, "seed"), "ip": ip("seed"), "card": card(value, "seed"), "ssn": digits(value, "seed"), "phone": digits(value, "seed")}
    cases["secret"] = f"if({value} rlike '^[0-9a-fA-F]+$', {hexadecimal(value, 'seed')}, {letters(value, 'seed')})"
    drawn = f"(case {' '.join(f"when {type} = '{kind}' then {body}" for kind, body in cases.items())} else {name(value, type, 'seed', attempt)} end)"
    last = f"if({attempt} > {ATTEMPTS}, concat('-', substr(seed, 1, 16)), '')"
    return let("seed", mac(key, f"concat_ws('|', {type}, {norm}, {attempt})"), f"concat({drawn}, {last})")


def found(text: Column) -> Column:
    """A text's parts: what lies between entities, and at odd places the entities. One pass of the pattern marks them."""
    one = F.split(F.regexp_replace(text, F.lit(PATTERN), F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    gaps, values = F.split(text, PATTERN, -1), F.concat(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array(F.lit("")))
    two = F.slice(F.flatten(F.zip_with(gaps, values, lambda g, v: F.array(g, v))), F.lit(1), 2 * F.size(gaps) - 1)  # the text holds the mark itself
    return F.when(~F.regexp_like(text, F.lit(HINT)), F.array(text)).when(F.contains(text, F.lit(MARK)), two).otherwise(one)


def entities(text: Column) -> Column:
    """All values found in a text, in order."""
    return F.when(F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _typed(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """The atoms of a column of values: type, norm, value."""
    parts = df.selectExpr(*keep, f"inline({let('k', kind(value), atoms(value, 'k'))})").toDF(*keep, "type", "value")
    return parts.selectExpr(*keep, "type", f"{normal('type', 'value')} as norm", "value")


def clashing(df: DataFrame, text: str, key: str) -> DataFrame | None:
    """type, norm, attempt of the atoms whose first surrogate is taken; None if there is none (as for most corpora below 10^8 values).

    A round draws only what clashed before. What is settled never moves again.
    """
    values = _typed(df.select(F.explode(entities(F.col(f"`{text}`"))).alias("found")), "found").groupBy("type", "norm").agg(F.min("value").alias("value"))
    open = cut(values, "entities")
    known = open.select("type", F.col("norm").alias("drawn"))
    settled: DataFrame | None = None
    moved: list[DataFrame] = []
    for attempt in range(ATTEMPTS + 2):
        last = attempt > ATTEMPTS
        drawn = open.selectExpr("type", "norm", "value", f"{let('made', surrogate('value', 'type', 'norm', str(attempt), key), normal('type', 'made'))} as drawn")
        taken = known if settled is None else known.unionByName(settled)
        first = drawn.groupBy("type", "drawn").agg(F.min("norm").alias("norm"))
        free = first.join(taken, ["type", "drawn"], "left_anti") if not last else drawn.select("type", "drawn", "norm")
        free = cut(free.select("type", "norm", "drawn"), "settled")
        if attempt:
            moved.append(free.select("type", "norm", F.lit(attempt).alias("attempt")))
        rest = cut(open.join(free, ["type", "norm"], "left_anti"), "entities")
        if rest.isEmpty():
            break
        settled = free.select("type", "drawn") if settled is None else settled.unionByName(free.select("type", "drawn"))
        open = rest
    if not moved:
        drop_cuts(open, free, rest)
        return None
    out = moved[0]
    for part in moved[1:]:
        out = out.unionByName(part)
    return out


def replace(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """df with the text's entities replaced, plus their count."""
    body = F.col(f"`{text}`")
    clash = clashing(df, text, key)
    if clash is None:
        tries, rows = "0", df
    else:  # few values: their texts' own maps are joined by the texts' digests
        digest = F.sha2(body, 256)
        held = df.select(digest.alias("__pii_digest"), F.explode(F.array_distinct(entities(body))).alias("__pii_value")).distinct()
        typed = _typed(held, "__pii_value", "__pii_digest").join(clash, ["type", "norm"])
        maps = typed.groupBy("__pii_digest").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct(F.concat_ws("|", "type", "norm"), "attempt")))).alias("__pii_tries"))
        rows = df.withColumn("__pii_digest", digest).join(maps, "__pii_digest", "left").drop("__pii_digest")
        tries = "coalesce(try_element_at(__pii_tries, concat_ws('|', a.t, n)), 0)"
    count = free_name(df, "n_entities")
    one = let("n", normal("a.t", "a.v"), let("t", tries, surrogate("a.v", "a.t", "n", "t", key)))
    prefix = f"if(k = 'person', regexp_extract(p, {quoted(f'^{PREFIX}')}, 0), '')"
    swap = let("k", kind("p"), f"concat({prefix}, array_join(transform({atoms('p', 'k')}, a -> {one}), ' '))")
    joined = F.expr(f"array_join(transform(__pii_parts, (p, at) -> if(at % 2 = 1, {swap}, p)), '')")
    out = rows.withColumn("__pii_parts", found(body)).withColumn("__pii_n", F.coalesce(F.greatest(F.floor(F.size("__pii_parts") / 2).cast("int"), F.lit(0)), F.lit(0)))
    columns = [F.when(F.col("__pii_n") > 0, joined).otherwise(body).alias(text) if c == text else F.col(f"`{c}`") for c in df.columns]
    return out.select(*columns, F.col("__pii_n").alias(count))
