"""Cases in which an operator once did less than its whole job."""

import hashlib
import random

import numpy as np

from txrisk.llm import decontaminate, licenses, neighbours, packing, secrets
from txrisk.llm.common import prepare


def test_white_space_before_a_word_keeps_the_tokenizers_ids():
    tokenizer, ranks = packing.default_tokenizer()
    r = random.Random(11)
    texts = ["a\n\nb", "a\n\n\n\nb", "\t\tb", "x\n\n\n\ny", "", " \n", "a \n b", "\n\n", "b  c", "a\r\n\r\nb", "\n \n"]
    texts += ["".join(r.choice([" ", "\n", "\t", "\r\n", "\x0b", "a", "it's", "9", "é", "."]) for _ in range(r.randint(0, 30)))
              for _ in range(2000)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    for encoder in (packing.Encoder(tokenizer, ranks), packing.Encoder(tokenizer)):
        ids, at = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        for k, t in enumerate(texts):
            assert ids[at[k]: at[k + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_license_rules_fire_without_a_gate_word(spark):
    texts = {"CC0 1.0 Universal": "cc0-1.0", "CC BY-SA 4.0": "cc-by-sa-4.0",
             "Creative Commons Attribution 4.0 International": "cc-by-4.0", "a Creative Commons by-nc work": "cc-by-nc",
             "Released into the public\n * domain.": "public-domain", "All rights\nreserved": "proprietary",
             "proprietary and confidential": "proprietary", "confidential and confidential": "proprietary",
             "Redistribution and\n# use in source and binary forms, with or without\n# modification, are permitted": "bsd",
             "released under Apache 2.0": "apache-2.0", "made available under the MPL, v 2.0": "mpl-2.0", "plain words": ""}
    texts |= {pattern.replace("(?:at your option|\\(at your option\\))", "at your option"): label
              for pattern, label, *_ in licenses.TEXTS if "(?:" not in pattern or "option" in pattern}
    for element, names in licenses.CC_ELEMENTS:
        texts |= {f"CC {name}" + " 4.0" * with_version: f"cc-{element}" + "-4.0" * with_version
                  for name in names for with_version in (False, True)}
    rows = list(texts.items())
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in licenses.digest(df).collect()}
    assert [(t, label) for i, (t, label) in enumerate(rows) if label not in got[i]] == []


def test_items_of_five_and_six_words_are_found_inside_long_texts(spark):
    r = random.Random(3)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(5 + k % 2))) for k in range(6000)]
    items += [(6000 + k, "a b c d e f g h"[: 2 * n - 1]) for k, n in enumerate((5, 6, 7, 8))]
    texts = [" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(40)) for _ in range(len(items) + 1)]
    texts = [f"{a} {item} {b}" for a, b, (_, item) in zip(texts, texts[1:], items, strict=False)] + ["i0x0 i0x1 i0x2 i0x3", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string").repartition(3))
    want = {(k, k) for k in range(6000)} | {(6000 + d, 6000 + k) for d in range(4) for k in range(d + 1)}
    assert [(r.doc_id, r.item_id) for r in found.orderBy("doc_id", "item_id").collect()] == sorted(want)


def test_ordinary_secrets_reach_the_forest(spark):
    body = "\n".join("MIIEow" + "Ab3/" * 14 for _ in range(400))
    rsa = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B2C\n\n{body}\n-----END RSA PRIVATE KEY-----"
    line = f"-----BEGIN PRIVATE KEY-----\\n{body[:60]}\\n-----END PRIVATE KEY-----\\n"
    pgp = f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n{body}\n=a1B2\n-----END PGP PRIVATE KEY BLOCK-----"
    texts = {"password: Tr0ub4dor&3x": "Tr0ub4dor&3x", "password: correct-horse-battery-staple": "correct-horse-battery-staple",
             "DB_PASSWORD = S3cr3t!pass#word": "S3cr3t!pass#word", "PASS1=Tr0ub4dor&3x": "Tr0ub4dor&3x",
             "\"db_password\" : \"Vx!9 q#Lm@2z\",": "Vx!9 q#Lm@2z", "password      => 'hJ7$kk2!pQ'": "hJ7$kk2!pQ", "x=1;password=Gr8!w4ter#Q": "Gr8!w4ter#Q",
             "u=https://h/p?a=1&pwd=Zk4!w9Rt&n=2": "Zk4!w9Rt", "Authorization: Bearer qWx-Zr9~kP.0vT_b": "qWx-Zr9~kP.0vT_b", rsa: rsa, f"key = \"{line}\"": line[:-2], pgp: pgp}
    known = {"a: password: getPassword()": "getPassword()", "password: required": "required", "password = None": "None",
             "secret: ${DB_SECRET}": "${DB_SECRET}", "Author: Winter and": "Winter"}
    rows = [*texts.items(), *known.items()]
    huge = [(-1, "password=" + "a&b,c;d" * 200_000), (-2, 'pwd="' + "a\\\\b" * 200_000 + '"'), (-3, "x=" + "a-b" * 300_000)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)] + huge, "doc_id long, text string")
    judged = secrets.scan(df).collect()
    got = {i: {r.value: r.is_secret for r in judged if r.doc_id == i} for i in range(len(rows))}
    assert [(t, got[i]) for i, (t, v) in enumerate(rows) if v not in got[i]] == []
    assert [(t, got[i]) for i, (t, v) in enumerate(rows) if got[i][v] != (i < len(texts))] == []


def test_redact_by_place(spark):
    """Secrets go at their places; control characters, substrings and repeated rows stay whole."""
    prepare(spark)
    key = hashlib.sha1(b"place").hexdigest()
    long_token = "q" * 499 + "7" + hashlib.sha256(b"x").hexdigest()
    texts = ['password="Zx9!\x01qL#42" end \x02\x03', f'token = "{key}" but {key}x is no key and \x03\x04 stays', None, "", "\x01\x02\x03",
             f'api_key="{key}"', f'api_key="{key}"', f"see {long_token} here", "passwd: Tr0ub4dor&3x and Tr0ub4dor&3xyz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    forest = secrets.train(secrets.labelled_findings(spark))
    found = {}
    for r in secrets.scan(df, forest).collect():
        found.setdefault(r.doc_id, []).append((r.finding, r.value, r.is_secret))
    got = {r.doc_id: r.text for r in secrets.redact(df, forest).collect()}
    for i, text in enumerate(texts):
        want, at = "", 0
        for _, value, secret in sorted(found.get(i, [])):
            place = text.index(value, at)
            want += text[at:place] + (secrets.MARK if secret else value)
            at = place + len(value)
        assert got[i] == (want + text[at:] if text is not None else None)
    assert got[0] == 'password="[SECRET]" end \x02\x03'
    assert got[5] == got[6] == 'api_key="[SECRET]"'
    assert got[8] == "passwd: [SECRET] and Tr0ub4dor&3xyz"
    assert [v for _, v, _ in found[7]] == [long_token]


def test_votes_of_empties_and_ties(spark):
    """Empty texts vote among empties; equal cosines vote together; batches do not matter."""
    prepare(spark)
    texts = ["", None, "", " ", *["good words of a river and a stone"] * 40, *["### $$$ %%%"] * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(3 < i < 44)) for i in range(len(texts))], "doc_id long, quality int")
    model = neighbours.fit(docs, labels)
    got = {r.doc_id: r.score for r in neighbours.score(docs, model).collect()}
    assert got[0] == got[1] == got[2] == 0.0
    assert len({got[i] for i in range(4, 44)}) == 1 and got[4] > 0.9 and got[60] < 0.1
    alone = {r.doc_id: r.score for i in (5, 70) for r in neighbours.score(docs.where(f"doc_id = {i}"), model).collect()}
    assert alone == {i: got[i] for i in alone}
    mixed = neighbours.fit(docs, spark.createDataFrame([(0, 1), (1, 0), (2, 0), (9, 1)], "doc_id long, quality int"))
    assert abs(mixed.scores(np.zeros((1, neighbours.FEATURES + neighbours.SHAPES), np.float32))[0] - 1 / 3) < 1e-9
    twice = docs.union(docs).union(docs.selectExpr("doc_id", "concat(text, ' z') as text"))
    assert len(neighbours.fit(twice, labels).labels) == len(texts)
