from jobweave.plans import registry


def test_all_fields_of_every_page(spark, tmp_path):
    columns = ("page_id bigint, title string, dateposted string, validthrough string, employmenttype string, hiringorganization struct<name:string>, identifier struct<name:string,value:string>, "
               "basesalary struct<currency:string,unittext:string,amount:string>, joblocation struct<addresslocality:string,addressregion:string>, monthsofexperience int, skills string")
    spark.createDataFrame([
        (1, " QA </script> \"Eng\" ", "2025-05-19", " ", "FULL_TIME", (" Acme ",), None, ("VND", "MONTH", "1200"), ("Quận 6", "Hưng Yên"), 36, "C++ ; Docker,, Go"),
        (2, None, None, None, None, None, None, None, None, None, None),
        (3, "  ", None, "2025-03-17", None, ("",), None, (None, "MONTH", None), (None, "Hà Nội"), None, " "),
        (4, "x", None, None, None, (None,), None, ("USD", None, None), (None, None), None, None)], columns).write.parquet(f"{tmp_path}/job_jsonld_pages.parquet")
    got = {r.page_id: r for r in registry.queries()["jsonld_fields"](spark, str(tmp_path)).collect()}
    assert tuple(got[1])[1:] == ('QA </script> "Eng"', "Acme", ["C++", "Docker", "Go"], "Quận 6, Hưng Yên", "1200 VND/month", "minimum 36 months", "FULL_TIME", "2025-05-19", None, None)
    assert all(x is None for x in tuple(got[2])[1:])
    assert (got[3].title_raw, got[3].company_name_raw, got[3].salary_raw, got[3].location_raw, got[3].expires_at_raw) == (None, None, None, "Hà Nội", "2025-03-17")
    assert (got[4].title_raw, got[4].company_name_raw, got[4].salary_raw, got[4].location_raw) == ("x", None, None, None)
