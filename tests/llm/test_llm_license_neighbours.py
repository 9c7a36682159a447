"""Notices of licences that share most of their words."""

from llm_cases import stored

from millrace.llm import license_scan

GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or any later version."
)
CC = "This work is licensed under a Creative Commons Attribution{} International License."
CASES = [
    (GNU.format(""), "gpl"),
    (GNU.format("Lesser "), "lgpl"),
    (GNU.format("Affero "), "agpl"),
    ("Licensed under the GNU Lesser General Public License", "lgpl"),
    (GNU.format("") + " " + GNU.format("Lesser "), "gpl,lgpl"),
    (CC.format(" 4.0"), "cc-by"),
    (CC.format(" 3.0"), "cc-by"),
    (CC.format("-NonCommercial 4.0"), "cc-by-nc"),
    (CC.format("-Non-Commercial 4.0"), "cc-by-nc"),
    (CC.format("-ShareAlike 4.0"), "cc-by-sa"),
    (CC.format("-NonCommercial-ShareAlike 4.0"), "cc-by-nc-sa"),
    (CC.format("-NoDerivatives 4.0"), "cc-by-nd"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("Licensed under the Apache License, Version 1.1", ""),
]


def test_neighbouring_licences(spark, tmp_path):
    docs = stored(spark, tmp_path, [(k, t) for k, (t, _) in enumerate(CASES)])
    got = {r.doc_id: r.labels for r in license_scan.scan(docs).collect()}
    assert [got[k] for k in range(len(CASES))] == [label for _, label in CASES]
