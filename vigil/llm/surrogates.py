"""Personal data replaced by keyed surrogates of the same type and form; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

MAX_ROUNDS = 64

# Titles that announce a person, by gender.
MALE = ("Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "M", "Г-н", "Господин", "Κύριος", "Κ")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Srta", "Madame", "Mme", "Mlle", "Г-жа", "Госпожа", "Κυρία", "Κα",
          "Professorin", "Doktorin", "Dra", "Profa")
NEUTRAL = ("Dr", "Prof", "Doctor", "Doktor", "Professor", "Mx", "Д-р", "Доктор", "Профессор", "Δρ")

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_TITLED = rf"(?:{_TITLES})\.?(?: (?:{_TITLES})\.?)*+ "
_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Types in order of precedence. Each pattern starts where a run starts, so a text is passed over once.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
          rf"|(?<![\p{{L}}0-9_:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]*[0-9]){_HEX}(?::{_HEX})*+::(?:{_HEX}(?::{_HEX})*+)?)"
          r"(?![\p{L}0-9_:]|\.[0-9])",
    "card": r"(?<![0-9.])(?:[0-9]{16}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|3[47][0-9]{13}"
            r"|3[47][0-9]{2}(?: [0-9]{6} |-[0-9]{6}-)[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![\p{L}0-9.+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})|\([0-9]{2,4}\))[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![\p{L}0-9.+])\+(?=(?:[ ./()-]{0,3}[0-9]){8,15}(?![0-9]))[0-9]{1,3}(?:[ ./-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,6}+(?![0-9])"
             r"|(?<![\p{L}0-9.+-])0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4})(?![0-9]|[.-][0-9])",
    "name": rf"(?<![\p{{L}}0-9]){_TITLED}\p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?",
}
ANY = "|".join(PATTERNS.values())
# A word that may be a further mention of a name, and what a name may have behind it there.
WORD = r"(?<![\p{L}0-9])\p{Lu}[\p{L}'’-]+"
ENDINGS = ("", "s", "'s", "’s", "'", "’")
# Texts without one of these have no entity.
HINT = rf"[0-9@]|(?:{_TITLES})\.? \p{{Lu}}"

# Syllables that surrogate names are spelled with, by script; given names end by gender.
SYLLABLES = {
    "cyrillic": "ба бе ви во га да де ди ка ко ла ле ли ма ми на ни но ра ри са се та ти".split(),
    "greek": "βα βε γα γο δα δη κα κο λα λε μα μη να νι πα πε ρα ρο σα σι τα τη φα φι".split(),
    "latin": "ba be bi da de do fa ga go ka ke la le li ma mi na no ra ri sa se ta vi".split(),
}
GIVEN_ENDS = {"cyrillic": ("н", "на", "й"), "greek": ("ς", "να", "ρ"), "latin": ("n", "na", "l")}


def quoted(pattern: str) -> str:
    """A pattern as an SQL literal."""
    return "r'" + pattern + "'" if "'" not in pattern else 'r"' + pattern + '"'


def luhn(digits: str) -> str:
    """SQL: whether a string of digits has a valid check digit."""
    return (f"aggregate(split(reverse({digits}), ''), named_struct('t', 0, 'odd', false), (a, c) -> named_struct("
            "'t', a.t + CASE WHEN a.odd THEN CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END "
            "ELSE CAST(c AS INT) END, 'odd', NOT a.odd), a -> a.t % 10 = 0)")


def classified(rows: DataFrame) -> DataFrame:
    """Rows with a column ``match`` get type, and of each part of the entity kind, k, canonical form, gender and
    script; type is null if it is no entity.

    The kind is the type, but a name of two words has the parts given (of the title's gender, if it has one) and
    name. Equal canonical forms of a kind are one entity, however they are written: an e-mail
    address in lower case, an address with all its groups, a name without its title, of numbers the letters and digits.
    """
    kinds = " ".join(f"WHEN match RLIKE {quoted('^(?:' + p + ')$')} THEN '{t}'" for t, p in PATTERNS.items())
    typed = derive(rows, {"_type": f"CASE {kinds} END"})
    bare = derive(typed, {
        "_plain": "regexp_replace(match, '[^A-Za-z0-9]+', '')",
        "_groups": "regexp_replace(lower(match), '(?<![0-9a-f])0+(?=[0-9a-f])', '')",
        "_person": f"regexp_replace(match, {quoted(f'^{_TITLED}')}, '')",
        "_titles": f"split(regexp_extract(match, {quoted(f'^{_TITLED}')}, 0), '[.]? ')"})
    female, male = (f"arrays_overlap(_titles, array({', '.join(quoted(t) for t in some)}))" for some in (FEMALE, MALE))
    cut = derive(bare, {
        "type": f"CASE WHEN _type = 'card' AND NOT {luhn('_plain')} THEN NULL ELSE _type END",
        "_sex": f"CASE WHEN {female} THEN 'f' WHEN {male} THEN 'm' ELSE '' END",
        "_parts": "CASE _type WHEN 'email' THEN array(lower(match)) WHEN 'name' THEN split(lower(_person), ' ') "
                  "WHEN 'ip' THEN array(CASE WHEN match NOT LIKE '%:%' THEN match ELSE trim(TRAILING ':' FROM replace(_groups, "
                  "'::', concat(':', repeat('0:', greatest(0, 8 - size(filter(split(_groups, ':'), g -> g <> ''))))))) END) "
                  "ELSE array(_plain) END"})
    parted = cut.select("*", F.posexplode("_parts").alias("k", "canonical"))
    return derive(parted, {
        "kind": "CASE WHEN _type = 'name' AND k + 1 < size(_parts) THEN 'given' ELSE type END",
        "gender": "CASE WHEN _type = 'name' AND k + 1 < size(_parts) THEN _sex ELSE '' END",
        "script": r"CASE WHEN _type <> 'name' THEN '' WHEN canonical RLIKE r'\p{IsCyrillic}' THEN 'cyrillic' "
                  r"WHEN canonical RLIKE r'\p{IsGreek}' THEN 'greek' ELSE 'latin' END",
    }).drop("_type", "_plain", "_groups", "_person", "_titles", "_sex", "_parts")


def _candidate(key: str) -> dict[str, str]:
    """SQL layers for the surrogate of (type, canonical, gender, script) at a given attempt.

    The seed is a keyed digest; what follows is drawn from it character by character.
    """
    secret = "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def draw(n, i):
        return f"CAST(pmod(xxhash64(_seed, {i}), {n}) AS INT)"

    def spelled(script, count, salt):
        array = "array(" + ", ".join(f"'{s}'" for s in SYLLABLES[script]) + ")"
        return (f"array_join(transform(sequence(1, {count}), i -> get({array}, "
                f"{draw(len(SYLLABLES[script]), f'i, {salt}')})), '')")

    def person(script):
        male, female, unknown = GIVEN_ENDS[script]
        end = f"CASE gender WHEN 'f' THEN '{female}' WHEN 'm' THEN '{male}' ELSE '{unknown}' END"
        longer = "attempt div 2"  # a longer name once the short ones are taken
        return (f"CASE type WHEN 'given' THEN initcap(concat({spelled(script, f'2 + {longer}', 1)}, {end})) "
                f"ELSE initcap({spelled(script, f'3 + {longer}', 2)}) END")

    def same_form(source, first="", i="i"):
        return (f"array_join(transform(split({source}, ''), (c, i) -> CASE {first} "
                f"WHEN c RLIKE '[0-9]' THEN CAST({draw(10, i)} AS STRING) "
                f"WHEN c RLIKE '[a-z]' THEN chr(97 + {draw(26, i)}) "
                f"WHEN c RLIKE '[A-Z]' THEN chr(65 + {draw(26, i)}) ELSE c END), '')")

    body = same_form("substring(canonical, 1, length(canonical) - 1)", "WHEN i = 0 THEN c")
    check = luhn("concat(_body, d)")
    local, site = "substring_index(canonical, '@', 1)", "substring_index(substring_index(canonical, '@', -1), '.', 1)"
    wide = "repeat('x', attempt div 4)"
    return {
        "_seed": f"sha2(concat_ws('|', {secret}, type, canonical, CAST(attempt AS STRING)), 256)",
        "_body": body,
        "surrogate": f"""CASE type
            WHEN 'email' THEN concat({same_form(f"concat({local}, {wide})")}, '@', {same_form(site, i='i, 7')}, '.example')
            WHEN 'ip' THEN CASE WHEN canonical LIKE '%:%' THEN concat('2001:db8', array_join(transform(sequence(1, 6),
                i -> concat(':', lower(hex({draw(65536, "i, 9")})))), '')) ELSE concat_ws('.', CASE WHEN attempt < 4 THEN '10' ELSE CAST(1 + {draw(223, -1)} AS STRING) END,
                CAST({draw(256, -2)} AS STRING), CAST({draw(256, -3)} AS STRING), CAST({draw(256, -4)} AS STRING)) END
            WHEN 'card' THEN concat(_body, element_at(filter(array('0','1','2','3','4','5','6','7','8','9'), d -> {check}), 1))
            WHEN 'iban' THEN concat(substring(canonical, 1, 2), {same_form("substring(canonical, 3)")})
            WHEN 'ssn' THEN concat('9', substring({same_form("canonical")}, 2))
            WHEN 'phone' THEN {same_form("canonical", "WHEN i = 0 THEN c")}
            ELSE CASE script WHEN 'cyrillic' THEN {person('cyrillic')} WHEN 'greek' THEN {person('greek')}
                 ELSE {person('latin')} END END""",
    }


def _candidates(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    layers = _candidate(key)
    rows = entities.withColumn("attempt", F.lit(attempt))
    for name, sql in layers.items():
        rows = derive(rows, {name: sql})
    return rows.selectExpr("type", "canonical", "gender", "script", "surrogate", "lower(surrogate) AS taken")


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for each entity (type, canonical, gender, script): distinct ones, none equal to an original.

    Rounds: every entity without a surrogate draws one; it is refused if it is an
    original of that type, taken already, or drawn by an entity with a smaller
    canonical form as well. The next round draws anew.
    """
    spark = entities.sparkSession
    originals = entities.select("type", F.col("canonical").alias("taken")).distinct()
    waiting, done = entities, None
    for attempt in range(MAX_ROUNDS):
        drawn = _candidates(waiting, key, attempt).join(originals, ["type", "taken"], "left_anti")
        if done is not None:
            drawn = drawn.join(done.select("type", "taken"), ["type", "taken"], "left_anti")
        drawn = written_table(spark, drawn, "drawn")
        first = drawn.groupBy("type", "taken").agg(F.expr("min(struct(canonical, gender, script))").alias("w")).selectExpr(
            "type", "w.canonical", "w.gender", "w.script")
        same = ["type", "canonical", "gender", "script"]
        won = drawn.join(first, same, "left_semi")
        done = written_table(spark, won if done is None else done.union(won), "surrogates")
        waiting = written_table(spark, entities.join(done.select(*same), same, "left_anti"), "waiting")
        if waiting.isEmpty():
            return done
    raise ValueError("no free surrogates are left for some entities: their form has too few values")


def _known(met: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, gender, script, surrogate) of all entities that ``met`` has."""
    entities = met.where("type IS NOT NULL").select("kind", "canonical", "gender", "script").distinct()
    genders = entities.where("gender <> ''").groupBy("kind", "canonical", "script").agg(F.max("gender").alias("elsewhere"))
    entities = written_table(met.sparkSession, entities.join(genders, ["kind", "canonical", "script"], "left").withColumn(
        "likely", F.expr("CASE WHEN kind = 'given' AND gender = '' THEN coalesce(elsewhere, '') ELSE gender END")).drop(
        "elsewhere"), "entities")
    if entities.isEmpty():
        return entities.selectExpr("kind", "canonical", "gender", "script", "'' AS surrogate")
    drawn = assigned(entities.selectExpr("kind AS type", "canonical", "likely AS gender", "script").distinct(), key)
    return entities.join(drawn.selectExpr("type AS kind", "canonical", "gender AS likely", "script", "surrogate"),
                         ["kind", "canonical", "likely", "script"]).drop("likely")


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replaces personal data in a text column: doc (all columns as they were), text, n_entities, found.

    ``found`` counts entities by type (map, empty if none). One row per input row.
    Found are e-mail addresses, IPv4 and IPv6 addresses, payment cards with a valid check
    digit, IBANs, social security numbers, phone numbers with an area code in
    brackets, a country code or five pairs of digits, names after titles, and further mentions of these names
    in their text: capitalised words equal to a part of one, also with an ending of ENDINGS. A surrogate keeps type and
    form: digits and letters in their places, the country of an IBAN or the first digit
    of a phone number or card (and a valid check digit), gender, script and number of
    words of a name; addresses move to a reserved domain or network. The same entity gets the
    same surrogate in all documents and spellings, different entities different ones; given names and surnames are
    entities of their own, so names agree in the parts that they share. A given name whose title tells no
    gender takes the one it has elsewhere. Whoever has ``key`` can find out surrogates again, so it has no default.

    Null and empty texts stay; repeated rows are treated alike; a table without
    entities, or without rows, passes unchanged; any other columns are carried along.
    Every text is matched once, in the pass that writes rows and matches. Texts without an entity are not shuffled.
    """
    if not key:
        raise ValueError("surrogates need a key")
    spark = docs.sparkSession
    packed = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc"))
    whole_text = F.col("doc").getField(text).cast("string")
    any_pattern, word = quoted(ANY), quoted(WORD)
    looked = written_table(spark, packed.withColumn("text", whole_text).selectExpr(
        "monotonically_increasing_id() AS row", "doc",
        f"CASE WHEN text RLIKE {quoted(HINT)} THEN regexp_extract_all(text, {any_pattern}, 0) ELSE array() END AS matches"), "looked")
    held = looked.where("size(matches) > 0").withColumn("text", whole_text)
    met = written_table(spark, classified(held.select("row", F.posexplode("matches").alias("place", "match"))), "met")
    known = _known(met, key)
    same = ["kind", "canonical", "gender", "script"]
    put = met.join(known, same, "left").withColumn("put", F.expr(
        f"""CASE WHEN surrogate IS NULL THEN match
            WHEN type IN ('email', 'ip') THEN surrogate
            WHEN type = 'name' THEN CASE WHEN k = 0 THEN concat(regexp_extract(match, {quoted(f'^{_TITLED}')}, 0), surrogate)
                ELSE concat(' ', surrogate) END
            ELSE array_join(transform(split(match, ''), (c, i) -> CASE WHEN c RLIKE '[A-Za-z0-9]' THEN substring(surrogate,
                length(regexp_replace(substring(match, 1, i + 1), '[^A-Za-z0-9]+', '')), 1) ELSE c END), '') END"""))
    put = written_table(spark, put.select("row", "place", "k", "put", "type", "kind", "canonical", "surrogate"), "put")
    whole = put.groupBy("row", "place").agg(
        F.array_join(F.expr("transform(sort_array(collect_list(struct(k, put))), p -> p.put)"), "").alias("put"),
        F.max("type").alias("type"))
    lists = whole.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "put", "type"))).alias("puts"))
    # Pieces and tokens take turns. Tokens are entities and, in texts with a name, the words between them.
    cut = held.join(lists, "row").selectExpr(
        "row", "doc", "puts", f"split(text, {any_pattern}, -1) AS gaps", "exists(puts, p -> p.type = 'name') AS named")
    cut = written_table(spark, cut.selectExpr(
        "row", "doc", "named", f"CASE WHEN named THEN flatten(transform(gaps, g -> split(g, {word}, -1))) ELSE gaps END AS pieces",
        f"""flatten(zip_with(gaps, puts, (g, p) -> concat(
            CASE WHEN named THEN transform(regexp_extract_all(g, {word}, 0), w -> struct(w AS put, CAST(NULL AS STRING) AS type, true AS word))
            ELSE array() END, CASE WHEN p IS NULL THEN array() ELSE array(struct(p.put AS put, p.type AS type, false AS word)) END)))
            AS tokens"""), "cut")
    names = put.where("type = 'name'").select("row", "kind", "canonical", "surrogate").distinct().select(
        "*", F.explode(F.array(*[F.lit(e) for e in ENDINGS])).alias("ending")).groupBy(
        "row", F.expr("concat(canonical, ending)").alias("key")).agg(
        F.expr("min(struct(length(ending) AS n, kind, canonical, surrogate, ending))").alias("name"))
    words = cut.where("named").select("row", F.posexplode("tokens").alias("at", "token")).withColumn(
        "key", F.expr("CASE WHEN token.word THEN lower(token.put) END"))
    replaced = words.join(names, ["row", "key"], "left").selectExpr("row", "at", """CASE WHEN name IS NULL THEN token ELSE struct(
        CASE WHEN upper(token.put) = token.put THEN upper(concat(name.surrogate, name.ending))
        ELSE concat(name.surrogate, name.ending) END AS put, 'name' AS type, true AS word) END AS token""")
    replaced = replaced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("told"))
    rebuilt = cut.join(replaced, "row", "left").withColumn("tokens", F.expr(
        "CASE WHEN named THEN transform(told, t -> t.token) ELSE tokens END")).selectExpr(
        "doc", "array_join(flatten(zip_with(pieces, tokens, (gap, t) -> array(gap, coalesce(t.put, '')))), '') AS text",
        # a given name and the surname behind it are one mention
        """transform(filter(tokens, (t, i) -> t.type IS NOT NULL AND NOT (t.word AND get(pieces, i) = ' '
            AND coalesce(get(tokens, i - 1).word AND get(tokens, i - 1).type IS NOT NULL, false))), t -> t.type) AS types""")
    plain = looked.where("size(matches) = 0").select("doc", whole_text.alias("text"), F.expr("CAST(array() AS array<string>) AS types"))
    return plain.unionByName(rebuilt).selectExpr(
        "doc", "text", "CAST(size(types) AS BIGINT) AS n_entities",
        "map_from_arrays(array_sort(array_distinct(types)), transform(array_sort(array_distinct(types)), "
        "t -> size(filter(types, x -> x = t)))) AS found")
