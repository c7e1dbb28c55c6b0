"""What the corpus operators share."""

import re
from pathlib import Path

from quern.llm.common import stored


def test_storing_a_table_returns_what_the_drivers_jvm_has_freed(spark):
    java = spark._jvm.java
    field = java.lang.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    memory, status = field.get(None), Path(f"/proc/{java.lang.ProcessHandle.current().pid()}/status")

    def held() -> float:
        return int(re.search(r"RssAnon:\s+(\d+)", status.read_text())[1]) / 1024

    stored(spark.range(10), "warm")
    size, blocks = 100_000, []
    for _ in range(3000):
        blocks.append(memory.allocateMemory(size))
        memory.setMemory(blocks[-1], size, 1)
    pins = set(blocks[::300]) | {blocks[-1]}  # else the C library returns the end of what is free by itself
    for at in blocks:
        if at not in pins:
            memory.freeMemory(at)
    before = held()
    stored(spark.range(10), "probe")
    after = held()
    for at in pins:
        memory.freeMemory(at)
    assert before - after > 150
