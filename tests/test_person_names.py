import random

from pyspark.sql import functions as F

from mapweave.fixed_values import NAME_TITLES
from mapweave.functions.expressions import first_name, last_name
from mapweave.functions.person_names import MARK, is_well_formed_first, is_well_formed_last

CASES = {
    "Mary Smith": ("Mary", "Smith"),
    "Mary A. Smith PhD": ("Mary", "Smith"),
    "Mary Smith PhD": (None, "Mary Smith PhD"),
    "Mary Smith, PhD": ("Mary", "Smith"),
    "Mary Smith, MBBCH, MSCE MPH ": ("Mary", "Smith"),
    "Smith, John": ("John", "Smith"),
    "Smith, J.": ("J.", "Smith"),
    "Smith, MD": (None, "Smith"),
    "Smith": (None, "Smith"),
    "Smith ": (None, "Smith"),
    "Smith  ": (None, "Smith  "),
    "Dr. Dr. Smith": (None, "Smith"),
    "Dr. J. Smith M.D.": ("J.", "Smith"),
    "Dr.": (None, "Dr."),
    "Mary (Molly) Smith": ("Mary", "Smith"),
    "Mary (M) Smith": (None, "Mary (M) Smith"),
    "J Smith-Jones, MD, PhD": ("J", "Smith-Jones"),
    "Mary Smith-Jones-Brown": (None, "Jones"),
    "Mary Smith-J0nes-Brown": (None, "Mary Smith-J0nes-Brown"),
    "MaryAnn McSmith": ("MaryAnn", "McSmith"),
    "SMITH": (None, "SMITH"),
    "A B": (None, "A B"),
    "unknown": ("unknown", "unknown"),
    "Pending": ("Pending", "Pending"),
    "unknown x": (None, "unknown x"),
    "unknown ": (None, "unknown "),
    "unknown Smith": (None, "unknown Smith"),
    "7-unknown ": ("unknown", "unknown"),
    "Pendingx": (None, "Pendingx"),
    "unknown, x": ("unknown", "unknown"),
    "Pending/7": ("Pending", "Pending"),
    "Foo-": (None, "Foo-"),
    "-Foo": (None, "Foo"),
    "--Foo": (None, "--Foo"),
    "7 - Mary Smith, MD - z": ("Mary", "Smith"),
    "7, 8 - 9": (None, "7, 8 - 9"),
    "A/B": (None, "A/B"),
    "Grant/x": (None, "Grant"),
    "Mary Smith/2/3": ("Mary", "Smith"),
    "Smith for Jones": ("Smith", "Jones"),
    "Stanford 7": (None, "Stan"),
    "Smith for 7": (None, "Smith"),
    "for": (None, "for"),
    ",": (None, ","),
    " Smith, 7": (None, "Smith"),
    "\tSmith\n/7": (None, "Smith"),
    f"Mary{MARK}Smith": (None, f"Mary{MARK}Smith"),
    f"x-Smith{MARK}": (None, f"x-Smith{MARK}"),
    f"Mary Smith{MARK}-Lee": (None, "Lee"),
    "Müller": (None, "Müller"),
    "a\nb": (None, "a\nb"),
    "": (None, ""),
    None: (None, None),
}


def split_names(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, x string")
    out = df.select("i", first_name(F.col("x")), last_name(F.col("x"))).orderBy("i")
    return [(r[1], r[2]) for r in out.collect()]


def test_cases(spark):
    assert dict(zip(CASES, split_names(spark, CASES))) == CASES


def test_long_inputs(spark):
    names = ["Dr. " * 20_000 + "Smith", "Smith" + " MD" * 20_000, "x " * 50_000, "Sm" * 100_000]
    assert split_names(spark, names) == [
        (None, "Smith"),
        (None, "Smith"),
        (None, names[2]),
        (None, names[3]),
    ]


def random_word(rng):
    while True:
        word = rng.choice("ABCDEFGHJKLMNRSTW") + "".join(
            rng.choice("abcdefgilmnorstu") for _ in range(rng.randint(1, 6))
        )
        if "for" not in word and word not in ("Dr", "Ms"):
            return word


def random_name(rng):
    return random_word(rng) if rng.random() < 0.8 else f"{random_word(rng)}-{random_word(rng)}"


def random_first(rng):
    return random_name(rng) if rng.random() < 0.7 else rng.choice(["J", "M.", "x", "q."])


def built_name(rng):
    """A name put together from its parts, and the parts."""
    first, last = random_first(rng), random_name(rng)
    form = rng.choice(["fml", "fl", "lf", "l"])
    middle = rng.choice([f"({random_name(rng)})", random_first(rng)])
    text = {
        "fml": f"{first} {middle} {last}",
        "fl": f"{first} {last}",
        "lf": f"{last}, {first}",
        "l": last,
    }[form]
    titles = [rng.choice(["", ","]) + " " + rng.choice(NAME_TITLES) for _ in range(rng.randint(0, 3))]
    if form == "l":
        # "Last, MD" reads as a last and a first name.
        titles = []
    elif form == "fl" and titles and titles[0][0] == " ":
        # "First Last PhD" reads as three names.
        titles[0] = "," + titles[0]
    text = "Dr. " * rng.randint(0, 2) + text + "".join(titles) + rng.choice(["", " "])
    return text, (None if form == "l" else first, last)


def test_built_names_parse(spark):
    rng = random.Random(1)
    built = [built_name(rng) for _ in range(20_000)]
    got = split_names(spark, [text for text, _ in built])
    assert [(b, g) for b, g in zip(built, got) if b[1] != g] == []


def test_built_names_parse_after_a_cut(spark):
    rng = random.Random(2)
    built = []
    while len(built) < 20_000:
        text, parts = built_name(rng)
        if "-" in text:
            continue
        cuts = ["7 - {} ", "x9-{}-8, 9", "7 -\t{}\n- "]
        if "," not in text:
            cuts += [" {}, 7", "{}/7", "\t{} /8 for", "{}\tfor 8"]
        built.append((rng.choice(cuts).format(text), parts))
    got = split_names(spark, [text for text, _ in built])
    assert [(b, g) for b, g in zip(built, got) if b[1] != g] == []


def test_well_formed(spark):
    df = spark.createDataFrame(
        [("J",), ("J.",), ("Jo",), ("Jo-Al",), ("JO",), ("J..",), ("Jo ",), ("",)], "x string"
    )
    got = df.select(is_well_formed_first(F.col("x")), is_well_formed_last(F.col("x"))).collect()
    assert [r[0] for r in got] == [True, True, True, True, False, False, False, False]
    assert [r[1] for r in got] == [False, False, True, True, False, False, False, False]
