import pytest

from jobweave.llm import pii


def proposed(text, kind):
    return {text[s["a"]:s["b"]] for s in pii.spans_of(text) if s["pii_type"] == kind}


@pytest.mark.parametrize("text,want", [
    ("gọi 0912345678 0987654321 0901234567 nhé", {"0912345678", "0987654321", "0901234567"}), ("gọi 0912345678-0987654321 nhé", {"0912345678", "0987654321"}),
    ("gọi 0912 345 678 0987 654 321 +84 901 234 567 0903334444 nhé", {"0912 345 678", "0987 654 321", "+84 901 234 567", "0903334444"}), ("gọi 0912-045-678 nhé", {"0912-045-678"})])
def test_every_number_of_a_run(text, want):
    assert proposed(text, "PHONE") == want


def test_names_in_long_runs_are_proposed(spark):
    text = "Liên hệ Chị Trần Thị Mai Hương Phòng Nhân Sự để biết thêm."
    assert "Trần Thị Mai Hương" in proposed(text, "NAME")
    df = spark.createDataFrame([(i, text if i == 0 else f"Gặp chị {n} (HR). ") for i, n in enumerate(["", *["Trần Thị Mai Hương", "Lê Văn Khuê", "Nguyễn Lĩnh Vịnh"] * 20])], "id int, text string")
    spans = pii.find(df, "id", "text").where("id = 0 AND pii_type = 'NAME'").collect()
    assert len(spans) == 1 and text[spans[0].a:spans[0].b].startswith("Trần Thị")
