"""Sentences that no template of the tables made: the model is trained on the tables, and has to hold here too."""

import os

import pytest

from jobweave.llm import pii, queries
from jobweave.session import table

SENTENCES = [
    # English
    ("Please reach Sarah Connelly on 415-555-0132 before noon.", [("NAME", "Sarah Connelly"), ("PHONE", "415-555-0132")]),
    ("Your recruiter is Michael O'Brien.", [("NAME", "Michael O'Brien")]),
    ("Interviews are run by Priya Raghunathan and Tom Becker.", [("NAME", "Priya Raghunathan"), ("NAME", "Tom Becker")]),
    ("Manager Lisa Wong leads the team.", [("NAME", "Lisa Wong")]),
    ("Signed, Emily Carter", [("NAME", "Emily Carter")]),
    ("Our office is at 1600 Amphitheatre Parkway, Mountain View.", [("ADDRESS", "1600 Amphitheatre Parkway")]),
    ("Send references to careers@northwind-labs.org by Monday.", [("EMAIL", "careers@northwind-labs.org")]),
    ("Mr. David Kowalski will answer your questions.", [("NAME", "David Kowalski")]),
    ("Call our front desk: +1 212 555 0187.", [("PHONE", "+1 212 555 0187")]),
    ("His passport number is C8765432.", [("ID_NUMBER", "C8765432")]),
    ("Her SSN, 219-09-9999, was stored in plain text.", [("ID_NUMBER", "219-09-9999")]),
    ("Kind regards,\nHannah Fitzgerald", [("NAME", "Hannah Fitzgerald")]),
    ("Contact: Daniel Okafor (HR), daniel.okafor@brightpath.io", [("NAME", "Daniel Okafor"), ("EMAIL", "daniel.okafor@brightpath.io")]),
    ("The workshop takes place at 22 Baker Street, London.", [("ADDRESS", "22 Baker Street")]),
    ("Dr. Amelia Hart moved to the Berlin office in 2019.", [("NAME", "Amelia Hart")]),
    ("Write to laura[at]kestrel[dot]dev if you have questions.", [("EMAIL", "laura[at]kestrel[dot]dev")]),
    ("Ask for Ben Thornton at reception.", [("NAME", "Ben Thornton")]),
    ("Text me at (503) 555-0199 after the call.", [("PHONE", "(503) 555-0199")]),
    ("Invoice 20394857 covers 1,500 licences of Microsoft Azure.", []),
    ("We use Apache Kafka, Spring Boot and Google Cloud in New York.", []),
    ("Version 10.4.2.118 was released in March 2024.", []),
    ("Ticket number 884120934 was closed.", []),
    ("The Data Engineer reports to the Head of Platform.", []),
    ("Salary: 45,000,000 - 60,000,000 VND per month.", []),
    # Vietnamese
    ("Nguyễn Văn An sẽ phỏng vấn bạn vào thứ Ba.", [("NAME", "Nguyễn Văn An")]),
    ("Người phụ trách là Trần Thị Bích.", [("NAME", "Trần Thị Bích")]),
    ("Văn phòng ở nhà số 12 Nguyễn Trãi, Thanh Xuân, Hà Nội.", [("ADDRESS", "12 Nguyễn Trãi")]),
    ("Vui lòng gọi cho chị Phạm Thu Hà theo số 0987 654 321.", [("NAME", "Phạm Thu Hà"), ("PHONE", "0987 654 321")]),
    ("Địa chỉ: 45/7 đường Lê Lợi, phường Bến Nghé, quận 1.", [("ADDRESS", "45/7 đường Lê Lợi")]),
    ("Số CCCD của ứng viên: 001203004567.", [("ID_NUMBER", "001203004567")]),
    ("Hồ sơ gửi về tuyendung@congtyabc.vn trước ngày 30.", [("EMAIL", "tuyendung@congtyabc.vn")]),
    ("Anh Lê Quang Huy phụ trách nhóm di động.", [("NAME", "Lê Quang Huy")]),
    ("Zalo: 0912.345.678 (chị Hương)", [("PHONE", "0912.345.678"), ("NAME", "Hương")]),
    ("Giám đốc Vũ Minh Tuấn đã ký quyết định.", [("NAME", "Vũ Minh Tuấn")]),
    ("Số hộ chiếu B1234567 hết hạn năm sau.", [("ID_NUMBER", "B1234567")]),
    ("Mọi thắc mắc xin liên hệ Đặng Ngọc Mai, ĐT 024 3825 1234.", [("NAME", "Đặng Ngọc Mai"), ("PHONE", "024 3825 1234")]),
    ("Buổi phỏng vấn tại 18 Phố Huế, quận Hai Bà Trưng, Hà Nội.", [("ADDRESS", "18 Phố Huế")]),
    ("Doanh thu đạt 120.000.000 đồng trong quý II.", []),
    ("Chúng tôi dùng Node.js và React Native tại Đà Nẵng.", []),
    ("Mã đơn hàng 123456789 đã được giao.", []),
    ("Làm việc từ thứ Hai đến thứ Sáu tại Hồ Chí Minh.", []),
    ("Công ty Cổ phần Hoàng Long tuyển 20 nhân viên.", []),
    # German
    ("Ihre Ansprechpartnerin ist Frau Katrin Vogel.", [("NAME", "Katrin Vogel")]),
    ("Bitte senden Sie Ihre Unterlagen an bewerbung@muster-gmbh.de.", [("EMAIL", "bewerbung@muster-gmbh.de")]),
    ("Rufen Sie uns unter 030 1234567 an.", [("PHONE", "030 1234567")]),
    ("Das Gespräch findet in der Schillerstraße 17, 10625 Berlin statt.", [("ADDRESS", "Schillerstraße 17, 10625 Berlin")]),
    ("Herr Stefan Brandt leitet die Abteilung.", [("NAME", "Stefan Brandt")]),
    ("Mit freundlichen Grüßen,\nMonika Scholz", [("NAME", "Monika Scholz")]),
    ("Telefon: +49 89 12345678, Herr Dr. Weiss", [("PHONE", "+49 89 12345678"), ("NAME", "Weiss")]),
    ("Fragen beantwortet Ihnen Kollegin Sabine Lorenz.", [("NAME", "Sabine Lorenz")]),
    ("Die Bestellung 4711-2023 wurde am 12.03.2024 geliefert.", []),
    ("Wir arbeiten mit Microsoft Azure und Jenkins.", []),
    ("Die Deutsche Bank sucht 15 Entwickler.", []),
    # French
    ("Votre contact est Madame Claire Fontaine.", [("NAME", "Claire Fontaine")]),
    ("Écrivez à recrutement@lumiere-conseil.fr pour postuler.", [("EMAIL", "recrutement@lumiere-conseil.fr")]),
    ("Appelez le 01 42 68 53 00 entre 9h et 17h.", [("PHONE", "01 42 68 53 00")]),
    ("Nos bureaux se trouvent au 12 rue de la Paix, 75002 Paris.", [("ADDRESS", "12 rue de la Paix")]),
    ("Monsieur Jean-Luc Bernard dirige l'agence.", [("NAME", "Jean-Luc Bernard")]),
    ("La responsable, Sophie Lemaire, vous répondra.", [("NAME", "Sophie Lemaire")]),
    ("Cordialement,\nJulien Marchand", [("NAME", "Julien Marchand")]),
    ("La commande 55120934 a été livrée.", []),
    ("Nous utilisons Google Cloud depuis 2021.", []),
    # Japanese
    ("担当：佐藤 健一", [("NAME", "佐藤 健一")]),
    ("田中さんが面接を担当します。", [("NAME", "田中")]),
    ("応募はjinji@sakura-works.jpまでお送りください。", [("EMAIL", "jinji@sakura-works.jp")]),
    ("電話 03-1234-5678 までご連絡ください。", [("PHONE", "03-1234-5678")]),
    ("鈴木 花子様よりご紹介いただきました。", [("NAME", "鈴木 花子")]),
    ("東京オフィスではJavaとPythonを使います。", []),
    ("注文番号 1029384756 は発送済みです。", []),
    ("年俸は6,000,000円から8,000,000円です。", []),
]
TRAINED_ON = "/root/testdata/sf0.01"


def measured(found):
    """(share of the true spans that begin where one of the kind was found, share of the found that are true)."""
    want = {(i, kind, text.index(part)) for i, (text, spans) in enumerate(SENTENCES) for kind, part in spans}
    return len(found & want) / len(want), len(found & want) / max(1, len(found)), want


@pytest.mark.skipif(not os.path.exists(TRAINED_ON), reason="trains on the test tables")
def test_unseen_wording(spark):
    things = queries._things(spark, TRAINED_ON)
    jobs = table(spark, TRAINED_ON, "synthetic_jobs").select("record_id", "description_raw")
    weights = pii.span_model(pii.candidates(jobs, "record_id", "description_raw", things))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTENCES)], "id int, text string")
    found = {(r.id, r.pii_type, r.a) for r in pii.find(df, "id", "text", things=things, weights=weights).collect()}
    recall, precision, want = measured(found)
    print(recall, precision, sorted((SENTENCES[i][0], k, a) for i, k, a in want - found), sorted((SENTENCES[i][0], k, a) for i, k, a in found - want), sep="\n")
    assert len(SENTENCES) >= 60 and recall >= 0.9 and precision >= 0.9
